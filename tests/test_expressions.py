import hashlib
import uuid

from pyspark.sql import functions as F

from tallyford.functions import histograms, ids, sql_names
from tallyford.operators.lookups import mapping_table, member_list


def test_event_key_is_null_with_a_null_part(spark):
    row = spark.sql("SELECT TIMESTAMP'2018-05-03 00:00:00' AS t, 'o' AS o, CAST(NULL AS STRING) AS n").select(
        ids.event_key("t", "o", F.lit("daily")).alias("a"), ids.event_key("t", "n").alias("b")).head()
    assert (row.a, row.b) == ("2018-05-03 00:00:00^o^daily", None)


def test_name_uuid(spark):
    texts = ["", "a", "org^user", "ünïcode"]
    rows = spark.createDataFrame([(t,) for t in texts], "s string").select("s", ids.name_uuid("s").alias("u")).collect()
    for s, u in rows:
        digest = hashlib.md5(s.encode()).digest()
        assert u == str(uuid.UUID(bytes=digest, version=3))


def test_file_name_and_percent(spark):
    row = spark.range(1).select(
        ids.file_name(F.lit("/a/b/c.json")).alias("f"), ids.percent(F.lit(2.0), F.lit(3.0)).alias("p"),
        ids.percent(F.lit(1), F.lit(0)).alias("z"), ids.percent(F.lit(-1.0), F.lit(3.0)).alias("n")).head()
    assert tuple(row) == ("c.json", 66, None, -33)


def test_average_of_minima(spark):
    bins = "array<struct<duration:bigint,max:bigint,min:bigint>>"
    rows = [([(10, 0, 4), (30, 0, 8)],), ([],), (None,), ([(0, 0, 5)],)]
    got = spark.createDataFrame(rows, f"h {bins}").select(histograms.average_of_minima("h").alias("x")).collect()
    assert [r.x for r in got] == [(10 * 5 + 30 * 9) / 40, 0.0, 0.0, 0.0]


def test_sql_functions_match(spark):
    sql_names.register(spark)
    sql_names.register_mapping(spark, "ep1", mapping_table(spark, {"A|x": "Desktop", "|x": "Web"}))
    sql_names.register_excluded_orgs(spark, member_list(spark, ["o1"], "o"))
    sql_names.register_test_users(spark, member_list(spark, ["u1"], "u"))
    sql_names.register_tag_filter(spark, ['appname":"conv"'])
    spark.sql("SELECT * FROM VALUES ('A', 'x', 'o1', 'u2'), (NULL, 'x', 'o2', 'u1'), ('B', NULL, NULL, NULL) "
              "AS t(d, ua, o, u)").createOrReplaceTempView("sample")
    rows = spark.sql("SELECT ep1(d, ua), validOrg(o), testUser(u) FROM sample ORDER BY d NULLS FIRST").collect()
    assert [tuple(r) for r in rows] == [("Web", "0", 1), ("Desktop", "1", 0), ("Other", "0", 0)]
    row = spark.sql("""SELECT convertTimeString('2018-05-03T01:02:03Z'), shortUuid('a'), get_only_file_name('/x/y'),
        calcAvgFromHistMin(array(named_struct('duration', 2L, 'max', 0L, 'min', 4L))), unixDay(0), leadingDay('x'),
        appFilter('{"appname":"conv"}'), appFilter('{"appname":"c"}'),
        getTimestampField('{"@timestamp":"t"}'),
        preprocess('{"a":1,"@message":"T: {\\\\"k\\\\":2}"}'), preprocess('{"@message":"T: {}"}'), preprocess('junk')
        """).head()
    assert tuple(row) == (
        "2018-05-03", str(uuid.UUID(bytes=hashlib.md5(b"a").digest(), version=3)), "y", 5.0, "1970-01-01", "", True,
        False, "t", '{"a":1,"SM":{"k":2}}', '{"SM":{}}', "junk")
    days = spark.sql("SELECT isBusinessDay('2019-11-28'), isBusinessDay('2019-11-29'), isBusinessDay('2019-05-27')")
    assert tuple(days.head()) == (False, True, False)


def test_sql_periods(spark):
    for period, want in (("daily", "2018-05-03"), ("weekly", "2018-04-29"), ("monthly", "2018-05-01")):
        sql_names.register_period(spark, period)
        row = spark.sql("SELECT aggregateStartDate(TIMESTAMP'2018-05-03 10:00:00'), periodTag('x')").head()
        assert (str(row[0])[:10], row[1]) == (want, period)
