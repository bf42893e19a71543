"""Stream sinks: files, topics and keyed tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..session import shared_folder
from ..sinks.tables import KeyedTable
from ..sinks.versions import VersionedFiles
from ..sources import jdbc, kafka

# Fixed value: default trigger interval.
TRIGGER = "10 seconds"
OUTPUT_MODES = ("append", "update", "complete")


def checkpoint_of(spark: SparkSession, name: str, root: str | None = None) -> str:
    return f"{(root or shared_folder(spark)).rstrip('/')}/{name}"


def _start(
    df: DataFrame, writer: DataStreamWriter, name: str, mode: str, trigger: str | None, root: str | None
) -> StreamingQuery:
    if mode not in OUTPUT_MODES:
        raise ValueError(f"output mode must be one of {OUTPUT_MODES}, not {mode!r}")
    schedule = {"availableNow": True} if trigger is None else {"processingTime": trigger}
    return (
        writer.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint_of(df.sparkSession, name, root))
        .trigger(**schedule).start())


def to_files(
    df: DataFrame, path: str, fmt: str, output: str, mode: str = "append", partition_key: str | None = None,
    trigger: str | None = TRIGGER, checkpoint_root: str | None = None, keys: Sequence[str] = (),
) -> StreamingQuery:
    """Files of a stream. Appended rows are plain files; `update` and `complete` make versions, read by `VersionedFiles`.

    Updates are merged by `keys`, and rewrite only the partitions of `partition_key` that a batch touches.
    """
    if mode in ("update", "complete"):
        target = VersionedFiles(path, fmt, keys, partition_key)
        if mode == "update" and not keys:
            raise ValueError("files of a stream in update mode need the keys that rows are merged by")
        return each_batch(df, lambda batch, number: target.write(batch, number, mode), f"sinkToFile_{output}", mode, trigger, checkpoint_root)
    writer = df.writeStream.format(fmt).option("path", path)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_key:
        writer = writer.partitionBy(partition_key)
    return _start(df, writer, f"sinkToFile_{output}", mode, trigger, checkpoint_root)


def to_topic(
    df: DataFrame, settings: Mapping, output: str, mode: str = "append", trigger: str | None = TRIGGER,
    checkpoint_root: str | None = None,
) -> StreamingQuery:
    writer = kafka.topic_writer(df, settings, settings.get("topic", output))
    return _start(df, writer, f"sinkToKafka_{output}", mode, trigger, checkpoint_root)


def to_keyed_table(
    df: DataFrame, table: KeyedTable, output: str, mode: str = "update", trigger: str | None = TRIGGER,
    checkpoint_root: str | None = None,
) -> StreamingQuery:
    """Merge every batch into a keyed table; a batch that runs again writes the same rows."""
    return each_batch(df, lambda batch, _: table.upsert(batch), f"sinkToTable_{output}", mode, trigger, checkpoint_root)


def each_batch(
    df: DataFrame, write: Callable[[DataFrame, int], None], name: str, mode: str = "update",
    trigger: str | None = TRIGGER, checkpoint_root: str | None = None,
) -> StreamingQuery:
    """Hand every batch to a function, which has to bear seeing a batch twice."""
    return _start(df, df.writeStream.foreachBatch(write), name, mode, trigger, checkpoint_root)


def to_jdbc(
    df: DataFrame, connect: Callable[[], object], table: str, keys: Sequence[str], output: str, mode: str = "update",
    trigger: str | None = TRIGGER, checkpoint_root: str | None = None, **options,
) -> StreamingQuery:
    """Upsert every batch into a JDBC table, which needs a key."""
    if not keys:
        raise ValueError("a stream into a JDBC table needs its primary key")

    def write(batch: DataFrame, _: int) -> None:
        jdbc.upsert_jdbc(batch, connect, table, keys, **options)

    return each_batch(df, write, f"sinkToJDBC_{output}", mode, trigger, checkpoint_root)


def to_catalog_table(
    df: DataFrame, table: str, output: str, trigger: str | None = TRIGGER, checkpoint_root: str | None = None
) -> StreamingQuery:
    """Append a stream to a catalog table."""
    name = f"sinkToHive_{output}"
    schedule = {"availableNow": True} if trigger is None else {"processingTime": trigger}
    return (
        df.writeStream.queryName(name).outputMode("append").trigger(**schedule)
        .option("checkpointLocation", checkpoint_of(df.sparkSession, name, checkpoint_root)).toTable(table))


def await_all(spark: SparkSession, timeout: float | None = None) -> None:
    """Wait until one of the running streams ends or fails, then stop the others."""
    try:
        if timeout is None:
            spark.streams.awaitAnyTermination()
        else:
            spark.streams.awaitAnyTermination(timeout)
    finally:
        for query in spark.streams.active:
            query.stop()
