import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyford.operators import lookups, sets, shaping


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_parse_value_keeps_every_row(spark):
    rows = shaping.parse_value(lines(spark, '{"a":1}', "bad", None, '{"b":2}'), "a INT").collect()
    assert [(r.a, r.raw) for r in rows] == [(1, '{"a":1}'), (None, "bad"), (None, None), (None, '{"b":2}')]


def test_json_is_parsed_once(spark):
    parsed = shaping.parse_value(lines(spark, '{"a":1,"b":"x"}'), "a INT, b STRING")
    plan = parsed.where((F.col("a") == 1) & (F.col("b") == "x") & (F.col("b") != "y"))._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("from_json") == 1


def test_schema_of_sample(spark, tmp_path):
    schema = shaping.schema_of_sample(spark, '{"b": 1, "a": {"c": [true]}}')
    assert schema.simpleString() == "struct<a:struct<c:array<boolean>>,b:bigint>"
    path = tmp_path / "s.json"
    path.write_text('{"b": 1,\n "a": "x"}')
    assert shaping.schema_of_file(spark, str(path)).simpleString() == "struct<a:string,b:bigint>"


def test_retype(spark):
    schema = StructType.fromDDL("n INT, s STRING, gone DOUBLE")
    df = spark.createDataFrame([("7", 1, "r", "extra"), ("x", 2, None, None)], "n string, s int, raw string, more string")
    out = shaping.retype(df, schema)
    assert out.columns == ["n", "s", "gone", "raw"]
    assert [tuple(r) for r in out.collect()] == [(7, "1", None, "r"), (None, "2", None, None)]
    assert shaping.retype(lines(spark, '{"n":3}'), schema).select("n", "raw").head() == (3, '{"n":3}')


def test_has_column(spark):
    df = spark.sql("SELECT named_struct('b', 1) AS a, 2 AS c")
    assert shaping.has_column(df, "a.b") and shaping.has_column(df, "c") and not shaping.has_column(df, "c.b")


def test_envelope_and_key(spark):
    df = spark.createDataFrame([("k", 1)], "a string, n int")
    salted = shaping.envelope(df, key="a").head()
    assert salted.key.startswith("k^") and len(salted.key) == 38 and json.loads(salted.value) == {"a": "k", "n": 1}
    assert shaping.envelope(df, key="a", value="n").select(shaping.unsalted_key().alias("k")).head().k == "k"
    assert shaping.envelope(df).columns == ["value"]
    fixed = shaping.envelope(df, key="a", salt=F.lit("s")).head().key
    assert fixed == "k^s"


def test_received_time(spark):
    texts = ['{"timeRcvd":"a","@timestamp":"b"}', '{"@timestamp":"b"}', '{"x":1}', "bad", None]
    got = lines(spark, *texts).select(shaping.received_time().alias("t")).collect()
    assert [r.t for r in got] == ["a", "b", "", "", ""]


@pytest.mark.parametrize("text,want", [
    ('{"appname":"conv", "n": 1}', '{"appname":"conv", "n": 1}'),
    ('{"a":1,"@message":"TAG: {\\"x\\":{\\"y\\":[1,\\"}\\"]}}"}', '{"a":1,"SM":{"x":{"y":[1,"}"]}}}'),
    ('{"@message":"t:{}"}', '{"SM":{}}'),
    ('{"SM":5,"@message":"t:{\\"k\\":1}","z":"}"}', '{"z":"}","SM":{"k":1}}'),
    ('{"@message":"no colon"}', '{"@message":"no colon"}'),
    ('{"@message":"t: {bad"}', '{"@message":"t: {bad"}'),
    ('{"a":1,"a":2,"@message":"t:{}"}', '{"a":1,"a":2,"SM":{}}'),
    ('{"other":1}', '{"other":1}'),
    ("[1]", "[1]"), ("junk", "junk"), (None, None),
])
def test_unwrap_message(spark, text, want):
    assert lines(spark, text).select(shaping.unwrap_message().alias("v")).head().v == want


def test_tags(spark):
    texts = ['{"appname":"a"}', '{"_appname":"b"}', '{"appname":"ab"}', '{"appname":"a","x":{"appname":"b"}}',
             '{"featureName":"f:1"}']
    df = lines(spark, *texts)
    assert [r.value for r in df.where(shaping.tagged("value", "a , b")).collect()] == [texts[0], texts[1], texts[3]]
    assert df.where(shaping.tagged("value", ["f:1"], "featureName")).count() == 1
    split = shaping.split_by_tag(df, ["a", "b"]).groupBy("tag").count().collect()
    assert {r.tag: r["count"] for r in split} == {"a": 2, "b": 2}


def test_normalize_time(spark):
    df = lines(spark, "2018-05-03", "bad")
    assert [r.value is None for r in shaping.normalize_time(df, "value").collect()] == [False, True]
    typed = spark.sql("SELECT TIMESTAMP'2018-05-03 00:00:00' AS t")
    assert shaping.normalize_time(typed, "t") is typed
    with pytest.raises(ValueError):
        shaping.normalize_time(df, "gone")


def test_unreadable_times_are_counted(spark):
    from pyspark.sql import Observation

    df = lines(spark, "2018-05-03", "bad", None)
    for on_error, missing in (("null", 2), ("now", 0)):
        seen = Observation()
        out = shaping.normalize_time(df, "value", on_error, seen)
        assert sum(r.value is None for r in out.collect()) == missing
        assert seen.get == {"unreadable_times": 2, "day_only_times": 0, "rows": 3}


def test_table_rows(spark):
    df = spark.createDataFrame([("it's", 1, "r"), (None, None, "r")], "A string, B int, raw string")
    rows = shaping.escape_quotes(shaping.table_rows(df))
    assert rows.dtypes == [("a", "string"), ("b", "int")] and [tuple(r) for r in rows.collect()] == [("it''s", 1)]


def test_lookups(spark, tmp_path):
    (tmp_path / "m.csv").write_text("k,v\nx,1\n,blank\n")
    df = spark.createDataFrame([("x",), (None,), ("y",)], "k string")
    mapping = lookups.read_mapping(spark, str(tmp_path / "m.csv"))
    got = lookups.look_up(df, mapping, "k", "v", "none").collect()
    assert {r.k: r.v for r in got} == {"x": "1", None: "blank", "y": "none"}
    twice = mapping.unionAll(mapping)
    assert lookups.look_up(df, twice, "k", "v", "none").count() == 3
    flags = lookups.flag_members(df, lookups.member_list(spark, ["x", "x"], "m"), "k", "f").collect()
    assert {r.k: r.f for r in flags} == {"x": 1, None: 0, "y": 0}
    orgs = spark.createDataFrame([("x", 1), ("y", 0)], "org_id string, exclude int")
    assert {r.k for r in lookups.drop_members(df, lookups.excluded_orgs(orgs), "k").collect()} == {None, "y"}


def test_unions_and_differences(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "n int, s string")
    b = spark.createDataFrame([("x", 2.5, 1)], "s string, d double, n int")
    both = sets.balanced_union([b, a])
    assert both.columns == ["s", "d", "n"] and both.count() == 4
    one = a.where("n = 1").limit(1)
    assert sets.difference(a, one).count() == 1 and sets.difference(a, one, True).count() == 2
    assert [r.n for r in sets.complement(a, F.col("s") == "x").collect()] == [2]
