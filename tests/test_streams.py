import datetime as dt
import json
import os
import re
import uuid

import pytest
from pyspark.sql import functions as F

from tallyford.operators import periods
from tallyford.session import fresh_path
from tallyford.sinks.tables import KeyedTable
from tallyford.sinks.versions import VersionedFiles
from tallyford.sources import files as files_source
from tallyford.streaming import progress, sinks

SCHEMA = "time_stamp timestamp, orgId string, userId string"
AGGREGATE = ("eventKey STRING, time_stamp TIMESTAMP, orgId STRING, userCountByOrg BIGINT, period STRING, "
             "relation_name STRING")


def at(day, hour=12):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day - 1, hours=hour)


def events(n=200):
    return [(at(1 + i * 20 // n, i % 24), f"o{i % 3}", f"u{i % 11}") for i in range(n)]


def add_file(spark, folder, rows):
    """One more file; later calls make later files."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def counts(df, period="daily"):
    return periods.distinct_count(df, period, ["orgId"], "userId", "userCountByOrg", "activeUser")


def plain(df):
    return sorted(tuple(r) for r in df.select("eventKey", "userCountByOrg").collect())


def run(spark, df, table, name, root):
    query = sinks.to_keyed_table(df, table, name, trigger=None, checkpoint_root=root)
    query.awaitTermination()
    return query


@pytest.mark.parametrize("period", ["daily", "weekly", "monthly"])
def test_stream_equals_batch(spark, period):
    folder, rows = fresh_path(spark, "in"), events()
    for i in range(0, len(rows), 50):
        add_file(spark, folder, rows[i:i + 50])
    table = KeyedTable(fresh_path(spark, "out"), AGGREGATE, ["eventKey", "time_stamp"])
    run(spark, counts(stream(spark, folder), period), table, f"s{uuid.uuid4().hex}", fresh_path(spark, "ck"))
    assert plain(table.read(spark)) == plain(counts(spark.createDataFrame(rows, SCHEMA), period))


def test_restart_continues_and_late_rows_drop(spark):
    folder, root, name = fresh_path(spark, "in"), fresh_path(spark, "ck"), f"s{uuid.uuid4().hex}"
    table = KeyedTable(fresh_path(spark, "out"), AGGREGATE, ["eventKey", "time_stamp"])
    add_file(spark, folder, [(at(1), "o", "a"), (at(1), "o", "b")])
    run(spark, counts(stream(spark, folder)), table, name, root)
    add_file(spark, folder, [(at(1), "o", "b"), (at(2), "o", "a")])  # b is known, day 2 opens
    run(spark, counts(stream(spark, folder)), table, name, root)
    assert [n for _, n in plain(table.read(spark))] == [2, 1]
    add_file(spark, folder, [(at(9), "o", "a")])
    run(spark, counts(stream(spark, folder)), table, name, root)
    add_file(spark, folder, [(at(1), "o", "c"), (at(8), "o", "c")])  # day 1 is later than the delay, day 8 is not
    run(spark, counts(stream(spark, folder)), table, name, root)
    assert [(k[:10], n) for k, n in plain(table.read(spark))] == [
        ("2024-01-01", 2), ("2024-01-02", 1), ("2024-01-08", 1), ("2024-01-09", 1)]


def test_state_of_closed_periods_is_dropped(spark):
    folder = fresh_path(spark, "in")
    for day in range(1, 10):
        add_file(spark, folder, [(at(day), "o", f"u{i}") for i in range(20)])
    table = KeyedTable(fresh_path(spark, "out"), AGGREGATE, ["eventKey", "time_stamp"])
    query = run(spark, counts(stream(spark, folder)), table, f"s{uuid.uuid4().hex}", fresh_path(spark, "ck"))
    state = [op["numRowsTotal"] for op in query.lastProgress["stateOperators"]]
    assert len(state) == 2 and max(state) <= 3 * 20


def test_marked_periods(spark):
    df = spark.createDataFrame(events(), SCHEMA)
    assert not periods.is_marked(df)
    folder = fresh_path(spark, "in")
    add_file(spark, folder, events(10))
    assert periods.is_marked(periods.cut(stream(spark, folder), "daily", ["orgId"]))


def test_windows_start_on_sunday(spark):
    df = spark.createDataFrame(events(), SCHEMA)
    got = periods.tumbling(df, "time_stamp", "weekly", ["orgId"], F.count(F.lit(1)).alias("n"))
    assert {r.time_stamp.strftime("%w %H:%M") for r in got.collect()} == {"0 00:00"}
    cut = periods.cut(df, "weekly", ["orgId"]).groupBy("time_stamp", "orgId").agg(F.count(F.lit(1)).alias("n"))
    key = lambda r: (r.time_stamp, r.orgId, r.n)
    assert sorted(map(key, got.collect())) == sorted(map(key, cut.collect()))
    months = periods.tumbling(df, "time_stamp", "monthly", [], F.count(F.lit(1)).alias("n"))
    assert [(str(r.time_stamp)[:10], r.n) for r in months.collect()] == [("2024-01-01", 200)]


def test_file_sink_appends(spark):
    folder, out = fresh_path(spark, "in"), fresh_path(spark, "out")
    add_file(spark, folder, events(10))
    df = stream(spark, folder)
    query = sinks.to_files(
        df, out, "json", f"f{uuid.uuid4().hex}", partition_key="orgId", trigger=None, checkpoint_root=fresh_path(spark, "ck"))
    query.awaitTermination()
    assert query.name.startswith("sinkToFile_") and spark.read.json(out).count() == 10
    with pytest.raises(ValueError):
        sinks.to_files(df, out, "json", "x", mode="update")
    with pytest.raises(ValueError):
        sinks.to_jdbc(df, None, "t", [], "x")
    with pytest.raises(ValueError):
        KeyedTable(out, SCHEMA, ["orgId"]).delete(df)


def test_catalog_table_and_progress(spark):
    folder, name = fresh_path(spark, "in"), f"t_{uuid.uuid4().hex}"
    add_file(spark, folder, events(10))
    records = []
    listener = progress.watch(spark, records.append)
    try:
        query = sinks.to_catalog_table(
            stream(spark, folder), name, name, trigger=None, checkpoint_root=fresh_path(spark, "ck"))
        query.awaitTermination()
        assert spark.table(name).count() == 10
        for _ in range(100):
            kinds = [json.loads(r)["event"] for r in records]
            if "terminated" in kinds:
                break
            __import__("time").sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert kinds[0] == "started" and "progress" in kinds and kinds[-1] == "terminated"
    done = [json.loads(r)["progress"] for r in records if json.loads(r)["event"] == "progress"]
    assert sum(p["numInputRows"] for p in done) == 10


def test_await_all(spark):
    sinks.await_all(spark, timeout=1)
    assert not spark.streams.active


def files_below(folder):
    """Paths of all files of a versioned folder, without their random part, and the bytes of its pointers."""
    root = folder.removeprefix("file:")
    found = [os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if not f.endswith(".crc")]
    return sorted(re.sub(r"part-(\d+)-.*?(\.|$)", r"part-\1\2", f) for f in found)


def rollup(df):
    return periods.cut(df, "daily", ["orgId", "userId"], "time_stamp").groupBy("time_stamp", "orgId").agg(F.count(F.lit(1)).alias("n"))


@pytest.mark.parametrize("mode, fmt", [("update", "parquet"), ("complete", "json"), ("update", "csv")])
def test_stream_files_update_and_complete(spark, mode, fmt):
    folder, out, root = fresh_path(spark, "in"), fresh_path(spark, "out"), fresh_path(spark, "ck")
    name, rows, target = f"v{uuid.uuid4().hex}", events(), VersionedFiles(out, fmt, ["time_stamp", "orgId"], "time_stamp")

    def go():
        query = sinks.to_files(rollup(stream(spark, folder)), out, fmt, name, mode, "time_stamp", None, root, ["time_stamp", "orgId"])
        query.awaitTermination()

    for i in range(0, 150, 50):
        add_file(spark, folder, rows[i:i + 50])
    go()
    add_file(spark, folder, rows[150:])
    go()  # a restart goes on
    want = {tuple(r) for r in rollup(spark.createDataFrame(rows, SCHEMA)).collect()}
    # The end of the input may make batches without rows; each version is whole.
    assert {tuple(r) for r in target.read(spark).select("time_stamp", "orgId", "n").collect()} == want
    totals = [target.read(spark, v).agg(F.sum("n")).first()[0] for v in target.versions(spark)]
    assert totals == sorted(totals) and totals[0] == 50 and totals[-1] == 200
    target.expire(spark, 1)
    assert target.versions(spark) == target.versions(spark)[-1:] and {tuple(r) for r in target.read(spark).select("time_stamp", "orgId", "n").collect()} == want


def test_versioned_files_bear_repetition(spark):
    """A repeated batch, whole or after a crash before its pointer, leaves the same files; only touched partitions are written."""
    target = VersionedFiles(fresh_path(spark, "out"), "parquet", ["k"], "p")

    def batch(*rows):
        return spark.createDataFrame(list(rows), "p string, k long, v string")

    a = "a: 1/2"  # not a folder's name as it is
    target.write(batch((a, 1, "x"), (a, 5, "x"), ("b", 2, "x"), (None, 3, "x")), 0, "update")
    target.write(batch((a, 1, "y"), (a, 4, "y"), (a, 4, "y")), 1, "update")
    before, first = files_below(target.path), target.pointer(spark, 1)
    zero = target.pointer(spark, 0)["parts"]
    assert {name: folder == zero[name] for name, folder in first["parts"].items()} == {"b": True, "null": True, "a%3A 1%2F2": False}
    target.write(batch((a, 1, "y"), (a, 4, "y")), 1, "update")
    assert files_below(target.path) == before
    os.remove(f"{target.path.removeprefix('file:')}/_versions/{1:012d}.json")
    assert {r.v for r in target.read(spark).collect()} == {"x"}  # the batch was never there
    target.write(batch((a, 1, "y"), (a, 4, "y")), 1, "update")
    assert files_below(target.path) == before and target.pointer(spark, 1) == first
    want = {(a, 1, "y"), (a, 4, "y"), (a, 5, "x"), ("b", 2, "x"), (None, 3, "x")}
    assert {tuple(r) for r in target.read(spark).collect()} == want and target.read(spark).count() == 5
    target.write(batch(("c", 9, "z")), 2, "append")
    assert {tuple(r) for r in target.read(spark).collect()} == want | {("c", 9, "z")}
    target.write(batch(("d", 8, "w")), 3, "complete")
    assert [tuple(r) for r in target.read(spark).collect()] == [("d", 8, "w")]
    with pytest.raises(ValueError):
        VersionedFiles(target.path).write(batch(("a", 1, "x")), 9, "update")
    with pytest.raises(ValueError):
        VersionedFiles(fresh_path(spark, "none")).read(spark)


def test_batches_rewrite_the_periods_they_touch(spark):
    folder, root, name = fresh_path(spark, "in"), fresh_path(spark, "ck"), f"s{uuid.uuid4().hex}"
    table = KeyedTable(fresh_path(spark, "out"), AGGREGATE, ["eventKey", "time_stamp"], ["time_stamp"])

    def files():
        top = table.path.removeprefix("file:")
        return {day: sorted(f for f in os.listdir(f"{top}/{day}") if f.startswith("part")) for day in os.listdir(top) if "=" in day}

    add_file(spark, folder, [(at(1), "o", "a"), (at(2), "o", "a")])
    run(spark, counts(stream(spark, folder)), table, name, root)
    before = files()
    add_file(spark, folder, [(at(2), "o", "b"), (at(3), "o", "a")])
    run(spark, counts(stream(spark, folder)), table, name, root)
    after = files()
    assert [before[day] == after[day] for day in sorted(before)] == [True, False] and len(after) == 3
    assert [n for _, n in plain(table.read(spark))] == [1, 2, 1]


def test_a_chain_of_streams_goes_on_after_a_restart(spark):
    """Messages of the first stream reach the second, each from where its own checkpoint stands."""
    folder, root, name = fresh_path(spark, "in"), fresh_path(spark, "chain"), uuid.uuid4().hex
    table = KeyedTable(f"{root}/counts", AGGREGATE, ["eventKey", "time_stamp"], ["time_stamp"])

    def first():
        sinks.to_files(stream(spark, folder), f"{root}/facts", "json", f"a{name}", trigger=None, checkpoint_root=root).awaitTermination()

    def second():
        rows = files_source.stream_files(spark, root, "facts", "json", spark.read.parquet(folder).schema)
        run(spark, counts(rows), table, f"b{name}", root)

    add_file(spark, folder, [(at(1), "o", "a"), (at(1), "o", "b")])
    first()
    add_file(spark, folder, [(at(1), "o", "b"), (at(2), "o", "a")])
    second()
    assert [n for _, n in plain(table.read(spark))] == [2]
    first()
    second()
    second()
    assert [n for _, n in plain(table.read(spark))] == [2, 1]
