import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tallyford.operators import keyed
from tallyford.session import fresh_path, leaf_folders
from tallyford.sinks.files import write_files, write_summary
from tallyford.sinks.tables import KeyedTable, create_bucketed_table, insert_overwrite
from tallyford.sources import files, tables
from tallyford.sources.modes import save_mode

SCHEMA = "pdate STRING, k INT, a INT, b STRING"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def new_table(spark, partitioned=True):
    return KeyedTable(fresh_path(spark, "t"), SCHEMA, ["pdate", "k"], ["pdate"] if partitioned else [])


@pytest.mark.parametrize("partitioned", [True, False])
def test_upsert_merges_columns(spark, partitioned):
    table = new_table(spark, partitioned)
    assert table.read(spark).count() == 0
    table.upsert(spark.createDataFrame([("d1", 1, 10, "x"), ("d1", 2, 20, "y"), ("d2", 1, 30, "z")], SCHEMA))
    update = spark.createDataFrame([("d1", 1, None), ("d1", 3, 5)], "pdate string, k int, a int")
    for _ in range(2):  # a repeated write changes nothing
        table.upsert(update)
        assert rows(table.read(spark).na.fill(-1)) == [
            ("d1", 1, -1, "x"), ("d1", 2, 20, "y"), ("d1", 3, 5, None), ("d2", 1, 30, "z")]


def test_untouched_partitions_are_not_rewritten(spark):
    table = new_table(spark)
    table.upsert(spark.createDataFrame([("d1", 1, 1, "x"), ("d2", 1, 1, "x")], SCHEMA))
    def files_of(day):
        rows_ = spark.read.parquet(f"{table.path}/pdate={day}").select(F.input_file_name().alias("f"))
        return {r.f for r in rows_.collect()}

    before = files_of("d1"), files_of("d2")
    table.upsert(spark.createDataFrame([("d1", 1, 2, "x")], SCHEMA))
    assert files_of("d2") == before[1] and files_of("d1") != before[0]


def test_last_write_wins(spark):
    df = spark.createDataFrame([("d", 1, 1, "a"), ("d", 1, 3, "b"), ("d", 1, 2, "c")], SCHEMA)
    assert rows(keyed.last_write(df, ["pdate", "k"], F.col("a"))) == [("d", 1, 3, "b")]
    table = new_table(spark)
    table.upsert(df, F.col("a"))
    assert rows(table.read(spark)) == [("d", 1, 3, "b")]
    assert keyed.last_write(df.select("pdate", "k"), ["pdate", "k"]).count() == 1


@pytest.mark.parametrize("partitioned", [True, False])
def test_delete(spark, partitioned):
    table = new_table(spark, partitioned)
    table.upsert(spark.createDataFrame([("d1", 1, 1, "x"), ("d2", 1, 1, "x"), ("d2", 2, 1, "x")], SCHEMA))
    doomed = spark.createDataFrame([("d1", 1), ("d2", 2), ("d9", 9)], "pdate string, k int")
    table.delete(doomed)
    assert rows(table.read(spark)) == [("d2", 1, 1, "x")]
    if partitioned:  # nothing is left of the emptied day
        assert leaf_folders(spark, table.path, 1) == ["pdate=d2"]
    table.upsert(spark.createDataFrame([("d1", 7, 7, "w")], SCHEMA))
    assert rows(table.read(spark)) == [("d1", 7, 7, "w"), ("d2", 1, 1, "x")]
    table.delete(table.read(spark))
    assert rows(table.read(spark)) == []


def test_null_keys_match_themselves(spark):
    target = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    merged = keyed.merge_by_key(target, spark.createDataFrame([(None, 9)], "k string, v int"), ["k"])
    assert {r.k: r.v for r in merged.collect()} == {None: 9, "a": 2}
    assert keyed.delete_by_key(target, target.where("k IS NULL"), ["k"]).count() == 1


def test_bad_tables(spark):
    with pytest.raises(ValueError):
        KeyedTable("x", SCHEMA, ["k"], ["pdate"])
    with pytest.raises(ValueError):
        new_table(spark).upsert(spark.createDataFrame([("d", 1, 1)], "pdate string, k int, other int"))


def test_insert_overwrite(spark):
    name = f"t_{uuid.uuid4().hex}"
    ddl = f"CREATE TABLE IF NOT EXISTS {name} (k INT, v STRING, d STRING) USING ORC PARTITIONED BY (d)"
    first = spark.createDataFrame([("x", 1, "d1"), ("y", 2, "d2")], "v string, k int, d string")
    insert_overwrite(first, name, ["k", "v", "d"], ddl)
    insert_overwrite(spark.createDataFrame([("z", 3, "d2")], "v string, k int, d string"), name, ["k", "v", "d"], ddl)
    assert rows(spark.table(name)) == [(1, "x", "d1"), (3, "z", "d2")]
    with pytest.raises(ValueError):
        insert_overwrite(first, "other", ["k"], ddl)


def test_bucketed_table(spark):
    name = f"b_{uuid.uuid4().hex}"
    create_bucketed_table(spark.createDataFrame([(1, "x")], "k int, v string"), name, "k", "v", 4)
    assert spark.table(name).count() == 0 and spark.table(name).columns == ["k", "v"]


def test_save_modes():
    assert [save_mode(m) for m in ("Append", "update", "complete", "overwrite", "ignore")] == [
        "append", "append", "overwrite", "overwrite", "ignore"]
    with pytest.raises(ValueError):
        save_mode("merge")


def test_files(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(1, "2018-05-03"), (2, "2018-05-04"), (3, "2018-05-20")], "n int, pdate string")
    write_files(df, f"{root}/in", "parquet", "append", "pdate")
    write_files(df.drop("pdate"), f"{root}/plain", "csv", "overwrite")
    week = files.read_period(spark, root, "in, gone", "parquet", "2018-05-04", "weekly", "pdate", base_path=True)
    assert sorted(r.n for r in week.collect()) == [1, 2]
    month = files.read_period(spark, root, "in", "parquet", "2018-05-04", "monthly", "pdate", alias_column="run")
    assert {r.run for r in month.collect()} == {"2018-05-04"} and month.count() == 3
    assert files.read_period(spark, root, "in", "parquet", "2017-05-04", None, "pdate") is None
    assert files.read_files(spark, root, "gone", "json") is None
    aliased = files.read_period(spark, root, "in", "parquet", "2018-05-03", alias="pdate=%s")
    assert [r.n for r in aliased.collect()] == [1]
    pruned = files.read_partitions(spark, f"{root}/in", "parquet", "pdate", ["2018-05-03", "2018-05-20"])
    assert sorted(r.n for r in pruned.collect()) == [1, 3]
    assert all("2018-05-04" not in f for f in pruned.inputFiles())
    assert files.read_partitions(spark, f"{root}/in", "parquet", "pdate", ["2017-01-01"]) is None
    assert files.read_files(spark, root, "in, gone", "parquet").count() == 3
    write_summary(df, f"{root}/summary")
    assert len(list((tmp_path / "summary").glob("part-*.csv"))) == 1
    with pytest.raises(ValueError):
        write_summary(df, f"{root}/summary", max_rows=2)
    assert spark.read.csv(f"{root}/summary").count() == 3 and not (tmp_path / "summary.new").exists()


def test_json_files_plain_and_wrapped(spark, tmp_path):
    from pyspark.sql.types import StructType

    folder = tmp_path / "j"
    folder.mkdir()
    (folder / "a.json").write_text('{"a":1,"b":"x","extra":0}\n{"value":"{\\"a\\":2}"}\n')
    schema = StructType.fromDDL("a BIGINT, b STRING")
    out = files.read_files(spark, str(tmp_path), "j", "json", schema)
    assert sorted((tuple(r) for r in out.collect()), key=lambda r: r[0]) == [(1, "x", None), (2, None, '{"a":2}')]
    (folder / "t.tsv").write_text("5\ty\n")
    tsv = files.read_files(spark, str(folder), "t.tsv", "csv", schema, tab=True)
    assert [tuple(r) for r in tsv.collect()] == [(5, "y")]
    with pytest.raises(ValueError):
        files.stream_files(spark, str(tmp_path), "j", "json")


def test_table_reads(spark):
    df = spark.createDataFrame([
        ("2018-05", "2018-05-03", "a", dt.datetime(2018, 5, 3)), ("2018-05", "2018-05-03", "b", dt.datetime(2018, 5, 3)),
        ("2018-05", "2018-05-04", "a", dt.datetime(2018, 5, 4)), ("2018-06", "2018-06-04", "a", dt.datetime(2018, 6, 4)),
    ], "month string, pdate string, relation_name string, time_stamp timestamp")
    pick = lambda **kw: tables.select_rows(df, **kw).count()
    assert pick() == 4 and pick(month="2018-05") == 3
    assert pick(day="2018-05-03", relations="a, b") == 2 and pick(day="2018-05-03", relations=["a"]) == 1
    assert pick(day="2018-05-03", month_partition=True) == 2
    assert pick(day="2018-05-03", relations="a", whole_month=True) == 3
    assert pick(day="2018-05-04", relations="a", day_column="time_stamp") == 1
    assert df.where(tables.any_key("2018-05-03", "a,b")).count() == 2
    with pytest.raises(ValueError):
        pick(day="2018-05-03")


def test_null_partitions_keep_their_rows(spark, tmp_path):
    stored = KeyedTable(str(tmp_path / "t"), "part string, id int, v string", ["part", "id"], ["part"])
    rows = lambda *r: spark.createDataFrame(list(r), "part string, id int, v string")
    stored.upsert(rows((None, 1, "a"), (None, 2, "b"), ("x", 1, "c"), ("y", 1, "d")))
    stored.upsert(rows((None, 3, "e"), ("x", 1, "f")))
    assert sorted(map(tuple, stored.read(spark).collect()), key=str) == sorted(
        [(None, 1, "a"), (None, 2, "b"), (None, 3, "e"), ("x", 1, "f"), ("y", 1, "d")], key=str)
    stored.delete(spark.createDataFrame([(None, 1)], "part string, id int"))
    assert sorted(map(tuple, stored.read(spark).collect()), key=str) == sorted(
        [(None, 2, "b"), (None, 3, "e"), ("x", 1, "f"), ("y", 1, "d")], key=str)


def test_only_touched_folders_are_read(spark, tmp_path):
    stored = KeyedTable(str(tmp_path / "t"), "part int, id int", ["part", "id"], ["part"])
    stored.upsert(spark.range(40).selectExpr("cast(id as int) part", "1 id"))
    folders = [f"part={i}" for i in range(5)] + ["part=99"]
    assert {f.split("/")[-2] for f in stored._touched(spark, folders).inputFiles()} == set(folders[:5])
    assert stored._touched(spark, ["part=77"]) is None
