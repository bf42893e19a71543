import json
import os

import pytest
from pyspark.sql import functions as F

from tallyford.sources import jdbc, kafka, remote, tables

SETTINGS = {"broker": "b:1", "topic": "conv, locus", "env": "e", "topicPrefix": "_p_", "topicPostfix": "_x",
            "maxOffsetsPerTrigger": 5, "retries": 1, "lingerMs": 3, "fetchOffsetNumRetries": 9, "failOnDataLoss": False}


def test_topic_names():
    assert kafka.topic_names("conv, locus", SETTINGS) == "e_p_conv_x,e_p_locus_x"
    assert kafka.topic_names("a, b", {**SETTINGS, "useTopicPrefix": False}) == "a, b"


def test_read_options():
    stream, batch = kafka.read_options(SETTINGS, True), kafka.read_options(SETTINGS, False)
    assert stream["startingOffsets"] == "latest" and stream["maxOffsetsPerTrigger"] == "5"
    assert "endingOffsets" not in stream and stream["failOnDataLoss"] == "false"
    assert (batch["startingOffsets"], batch["endingOffsets"]) == ("earliest", "latest")
    assert "maxOffsetsPerTrigger" not in batch and batch["fetchOffset.numRetries"] == "9"
    offsets = {"conv": {"0": -2}}
    assert json.loads(kafka.read_options({**SETTINGS, "startingOffsets": offsets}, False)["startingOffsets"]) == offsets


def test_write_options():
    batch, stream = (kafka.write_options(SETTINGS, "out", s) for s in (False, True))
    assert batch["topic"] == "e_p_out_x" and batch["kafka.retries"] == "1" and "kafka.linger.ms" not in batch
    assert stream["kafka.linger.ms"] == "3"
    assert not any("ssl" in o for o in batch)
    secure = kafka.write_options({**SETTINGS, "ssl": "true", "truststore": "t", "securityProtocol": "SASL_SSL"}, "o", False)
    assert secure["kafka.ssl.truststore.location"] == "t" and secure["kafka.security.protocol"] == "SASL_SSL"


def test_messages(spark):
    rows = spark.createDataFrame([(b"k^salt", b'{"a":1}'), (None, b"x")], "key binary, value binary")
    assert [tuple(r) for r in kafka.messages(rows).collect()] == [("k", '{"a":1}'), (None, "x")]
    from pyspark.sql.types import StructType

    assert kafka.messages(rows, StructType.fromDDL("a INT")).columns == ["a", "raw"]


def test_jdbc_options():
    base = {"url": "u", "driver": "d", "username": "n", "password": "p"}
    assert jdbc.read_options({**base, "query": "q"})["query"] == "q"
    assert jdbc.read_options({**base, "dbtable": "t"})["dbtable"] == "t"
    part = jdbc.read_options({**base, "query": "q"}, {"column": "c", "lower": 0, "upper": 9, "slices": 3})
    assert part["dbtable"] == "(q) q" and part["numPartitions"] == "3" and "query" not in part
    with pytest.raises(ValueError):
        jdbc.read_jdbc(None, base, streaming=True)


def test_upsert_statements():
    update, insert = jdbc.upsert_statements("t", ["k", "a", "b"], ["k"])
    assert update == "UPDATE t SET a = ?, b = ? WHERE k = ?"
    assert " ".join(insert.split()) == (
        "INSERT INTO t (k, a, b) SELECT ?, ?, ? WHERE NOT EXISTS (SELECT 1 FROM t WHERE k = ?)")
    assert jdbc.upsert_statements("t", ["k"], ["k"])[0] == ""
    assert "FROM dual" in jdbc.upsert_statements("t", ["k"], ["k"], source="FROM dual")[1]


def recorder(folder):
    """A connection factory. The class is local, so that it travels to the tasks with the factory."""

    class Recorder:
        """Stands in for a database connection: notes what it is told in a file of its own."""

        def __init__(self):
            self.path = os.path.join(folder, f"{os.getpid()}-{id(self)}.jsonl")

        def note(self, *what):
            with open(self.path, "a") as f:
                f.write(json.dumps(what) + "\n")

        def cursor(self):
            return self

        def executemany(self, text, rows):
            self.note(text.split()[0], rows)

        def commit(self):
            self.note("commit")

        def close(self):
            self.note("close")

    return Recorder


def test_upsert_jdbc(spark, tmp_path):
    folder = str(tmp_path)
    df = spark.range(25).select(F.col("id").cast("int").alias("K"), F.lit("x").alias("A"), F.lit("r").alias("raw"))
    empty = spark.createDataFrame([(None, None, "r")], "K int, A string, raw string")
    jdbc.upsert_jdbc(df.unionAll(df).unionAll(empty), recorder(folder), "t", ["K"], commit_rows=4, connections=3)
    logs = [[json.loads(line) for line in open(tmp_path / f)] for f in os.listdir(folder)]
    assert 1 <= len(logs) <= 3 and all(log[-1] == ["close"] for log in logs)
    updates = [row for log in logs for entry in log if entry[0] == "UPDATE" for row in entry[1]]
    inserts = [row for log in logs for entry in log if entry[0] == "INSERT" for row in entry[1]]
    assert sorted(r[1] for r in updates) == list(range(25)) and sorted(r[0] for r in inserts) == list(range(25))
    assert all(len(entry[1]) <= 4 for log in logs for entry in log if len(entry) > 1)


def test_enrich_in_batches(spark):
    def call(body):
        return json.dumps([{**row, "twice": row["id"] * 2} for row in json.loads(body) if row["id"] != 3])

    got = remote.enrich_in_batches(spark.range(10), call, "id BIGINT, twice BIGINT", batch_rows=2)
    assert sorted(tuple(r) for r in got.collect()) == [(i, i * 2) for i in range(10) if i != 3]


def test_wide_table_options():
    from tallyford.sources.tables import wide_options

    got = wide_options({"host": "h", "port": 9042, "table": "t", "keyspace": "k", "username": "", "consistencyLevel": "ONE",
                        "saveMode": "update", "options": {"x": "y"}})
    assert got == {"table": "t", "keyspace": "k", "spark.cassandra.connection.host": "h", "x": "y",
                   "spark.cassandra.connection.port": "9042", "spark.cassandra.input.consistency.level": "ONE",
                   "spark.cassandra.output.consistency.level": "ONE"}


def test_document_write_skips_empty_frames(spark):
    from tallyford.sources.tables import write_documents

    assert write_documents(spark.range(0), {}) is False


def test_enrich_refuses_other_replies(spark):
    with pytest.raises(Exception, match="no JSON array of rows"):
        remote.enrich_in_batches(spark.range(3), lambda body: "busy", "id BIGINT").collect()


def test_days_of_a_time_column(spark):
    df = spark.sql("SELECT timestamp(d) AS t, substring(d, 1, 10) AS pdate, substring(d, 1, 7) AS month, 'r' AS relation_name "
                   "FROM VALUES ('2023-12-31 23:59:59'), ('2024-01-01 00:00:00'), ('2023-12-01 00:00:00'), ('2023-11-30 23:00:00') AS v(d)")

    def got(**more):
        return sorted(r.pdate for r in tables.select_rows(df, time_column="t", **more).collect())

    assert got(day="2023-12-31", relations="r") == ["2023-12-31"]
    assert got(month="2023-12") == ["2023-12-01", "2023-12-31"]
    assert got(day="2023-12-05", relations="r", whole_month=True) == ["2023-12-01", "2023-12-31"]
    assert got(day="2024-01-01", month_partition=True) == ["2024-01-01"]
