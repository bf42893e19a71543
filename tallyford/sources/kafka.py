"""Topic sources and sinks: option sets for Spark's Kafka connector, and the message layout.

The connector is a package the cluster supplies. Connection details always come from the caller.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from ..operators.shaping import envelope, parse_value, unsalted_key

# Setting name and the connector option it becomes.
READ_OPTIONS = {
    "fetchOffsetNumRetries": "fetchOffset.numRetries",
    "fetchOffsetRetryIntervalMs": "fetchOffset.retryIntervalMs",
    "failOnDataLoss": "failOnDataLoss",
}
WRITE_OPTIONS = {
    "retries": "kafka.retries",
    "retryBackoffMs": "kafka.retry.backoff.ms",
}
STREAM_WRITE_OPTIONS = {
    **WRITE_OPTIONS,
    "metadataFetchTimeoutMs": "kafka.metadata.fetch.timeout.ms",
    "lingerMs": "kafka.linger.ms",
    "batchSize": "kafka.batch.size",
    "timeoutMs": "kafka.timeout.ms",
    "requestTimeoutMs": "kafka.request.timeout.ms",
    "maxRequestSize": "kafka.max.request.size",
    "fetchOffsetNumRetries": "fetchOffset.numRetries",
    "fetchOffsetRetryIntervalMs": "fetchOffset.retryIntervalMs",
}
SECURE_OPTIONS = {
    "securityProtocol": "kafka.security.protocol",
    "kerberosServiceName": "kafka.sasl.kerberos.service.name",
    "truststore": "kafka.ssl.truststore.location",
    "trustStorePassword": "kafka.ssl.truststore.password",
    "keystore": "kafka.ssl.keystore.location",
    "keyStorePassword": "kafka.ssl.keystore.password",
    "sslPassword": "kafka.ssl.key.password",
    "groupIdPrefix": "groupIdPrefix",
}


def topic_names(topics: str, settings: Mapping) -> str:
    """Comma list of topics, each as env + prefix + name + postfix unless `useTopicPrefix` is off."""
    if not settings.get("useTopicPrefix", True):
        return topics
    env, prefix, postfix = (settings.get(k, "") for k in ("env", "topicPrefix", "topicPostfix"))
    return ",".join(f"{env}{prefix}{t}{postfix}" for t in "".join(topics.split()).split(","))


def _text(value) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    return value if isinstance(value, str) else json.dumps(value)


def _options(settings: Mapping, names: Mapping[str, str]) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": settings["broker"]}
    if str(settings.get("ssl", False)).lower() == "true":
        names = {**names, **SECURE_OPTIONS}
    options.update({option: _text(settings[name]) for name, option in names.items() if name in settings})
    return options


def read_options(settings: Mapping, streaming: bool) -> dict[str, str]:
    """Connector options of a read; a stream starts at the latest offset, a batch reads all."""
    options = _options(settings, READ_OPTIONS)
    options["subscribe"] = topic_names(settings["topic"], settings)
    options["startingOffsets"] = _text(settings.get("startingOffsets", "latest" if streaming else "earliest"))
    if streaming:
        if "maxOffsetsPerTrigger" in settings:
            options["maxOffsetsPerTrigger"] = _text(settings["maxOffsetsPerTrigger"])
    else:
        options["endingOffsets"] = _text(settings.get("endingOffsets", "latest"))
    return options


def write_options(settings: Mapping, topic: str, streaming: bool) -> dict[str, str]:
    options = _options(settings, STREAM_WRITE_OPTIONS if streaming else WRITE_OPTIONS)
    options["topic"] = topic_names(topic, settings)
    return options


def messages(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """(key, value) texts with the key's salt removed; parsed when a schema is given."""
    rows = df.select(unsalted_key(F.col("key").cast("string")).alias("key"), F.col("value").cast("string").alias("value"))
    return parse_value(rows, schema) if schema is not None else rows


def read_topics(
    spark: SparkSession, settings: Mapping, streaming: bool = False, schema: StructType | None = None
) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return messages(reader.format("kafka").options(**read_options(settings, streaming)).load(), schema)


def write_topic(df: DataFrame, settings: Mapping, topic: str) -> None:
    rows = envelope(df, settings.get("topicKey"), settings.get("topicValue"))
    rows.write.format("kafka").options(**write_options(settings, topic, False)).save()


def topic_writer(df: DataFrame, settings: Mapping, topic: str) -> DataStreamWriter:
    rows = envelope(df, settings.get("topicKey"), settings.get("topicValue"))
    return rows.writeStream.format("kafka").options(**write_options(settings, topic, True))
