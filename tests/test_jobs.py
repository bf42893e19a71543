import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyford.functions import sql_names, times
from tallyford.plans import jobs
from tallyford.plans.jobs import Job, backfilled, inherited_output, load_job, merged, run_plan
from tallyford.operators.lookups import mapping_table, member_list
from tallyford.plans.monitor_steps import Monitors
from tallyford.plans.sql_stage import sql_stage
from tallyford.plans.steps import Lookups
from tallyford.session import fresh_path
from tallyford.sinks.tables import KeyedTable


def step(name, **parameters):
    return {"queryName": name, "parameters": parameters}


def job(spark, root, **more):
    return Job(spark, settings={"dataLocation": str(root), "queryLocation": str(root), "schemaLocation": str(root)}, **more)


def test_results_fan_out(spark, tmp_path):
    add = lambda n: lambda df, p: df.withColumn("n", F.col("n") + n)
    j = job(spark, tmp_path, transforms={
        "src": lambda df, p: spark.createDataFrame([(1,)], "n int"), "plus1": add(1), "plus10": add(10)})
    out = run_plan(j, [[step("src"), step("src")], [step("plus1"), step("plus10"), {**step("plus1"), "disable": True}],
                       [step("plus1")]])
    assert sorted(r.frame.head().n for r in out) == [3, 3, 12, 12]


def test_sinks_end_branches_and_names_are_inherited(spark, tmp_path):
    make = lambda df, p: spark.createDataFrame([(1, p.get("tag"))], "n int, tag string")
    j = job(spark, tmp_path, transforms={"make": make, "same": lambda df, p: df})
    write = step("writeToFile", format="json", saveMode="append")
    out = run_plan(j, [
        [step("make", output="first", aggregatePeriod="daily")], [step("same", output="ignored")], [write],
        [step("make", output="second")], [write]])
    assert out == []
    assert (tmp_path / "first_daily").exists() and (tmp_path / "second").exists() and not (tmp_path / "ignored").exists()
    assert inherited_output({"output": "a", "aggregatePeriod": "weekly"}) == "a_weekly" and inherited_output({}) is None


def test_missing_input_ends_its_branch(spark, tmp_path):
    (tmp_path / "have").mkdir()
    (tmp_path / "have" / "a.json").write_text('{"n":1}\n')
    seen = []

    def note(df, p):
        seen.append(df)
        return df

    j = job(spark, tmp_path, transforms={"note": note})
    out = run_plan(j, [[step("readFromFile", input="gone", format="json")], [step("note")], [step("note")],
                       [step("readFromFile", input="have", format="json")], [step("note")]])
    assert len(seen) == 1 and len(out) == 1 and out[0].frame.head().n == 1


def test_backfill(spark, tmp_path):
    for day, n in (("2018-03-04", 1), ("2018-03-06", 2), ("2018-03-11", 4)):
        (tmp_path / "raw" / day).mkdir(parents=True)
        (tmp_path / "raw" / day / "raw.json").write_text("x\n" * n)
    read = {**step("readFromFile", input="raw", format="text", period="weekly"),
            "dateRange": {"startDate": "2018-03-06", "endDate": "2018-03-12"}}
    assert [s["parameters"]["date"] for s in backfilled(read)] == ["2018-03-04", "2018-03-11"]
    out = run_plan(job(spark, tmp_path), [[read]])
    assert [r.frame.count() for r in out] == [3, 4]


def test_sql_job_with_files(spark, tmp_path):
    """A job of files only: schema by sample, SQL texts, period functions, duplicates and two writes."""
    (tmp_path / "events").mkdir()
    (tmp_path / "events" / "e.json").write_text("".join(
        json.dumps({"time_stamp": f"2018-05-0{d}T10:00:00Z", "orgId": o, "userId": u}) + "\n"
        for d, o, u in [(3, "a", "x"), (3, "a", "x"), (3, "a", "y"), (4, "b", "z")]))
    (tmp_path / "event.json").write_text(json.dumps({"time_stamp": "", "orgId": "", "userId": ""}))
    (tmp_path / "count").write_text("""
        select aggregateStartDate(time_stamp) AS time_stamp, orgId, userId, 1 AS one FROM SOURCE_VIEW;
        CREATE OR REPLACE TEMP VIEW seen_once as DropDuplicates time_stamp, orgId, userId;
        SELECT concat_ws('^', time_stamp, orgId, periodTag(orgId)) AS eventKey, time_stamp, orgId, sum(one) AS users
        FROM seen_once GROUP BY ALL""")
    (tmp_path / "job.json").write_text(json.dumps({"name": "j", "queryPlan": [
        [step("readFromFile", input="events", format="json", schemaName="event", timeStampField="time_stamp")],
        [step("count", aggregatePeriod="daily", timeStampField="time_stamp", output="count"),
         step("count", aggregatePeriod="weekly", timeStampField="time_stamp", output="count")],
        [step("writeToCassandra", cassandra={"table": "agg", "saveMode": "update"}),
         step("writeToFile", format="json", saveMode="append", partitionKey="orgId")],
    ]}))
    table = KeyedTable(fresh_path(spark, "agg"), "eventKey STRING, time_stamp TIMESTAMP, orgId STRING, users BIGINT",
                       ["eventKey", "time_stamp"])
    j = job(spark, tmp_path, tables={"agg": table})
    assert run_plan(j, load_job(spark, str(tmp_path / "job.json"))) == []
    got = {r.eventKey: r.users for r in table.read(spark).collect()}
    assert got == {
        "2018-05-03 00:00:00^a^daily": 2, "2018-05-04 00:00:00^b^daily": 1,
        "2018-04-29 00:00:00^a^weekly": 2, "2018-04-29 00:00:00^b^weekly": 1}
    assert spark.read.json(str(tmp_path / "count_daily")).count() == 2


def test_sql_texts_use_the_lookups(spark, tmp_path):
    found = Lookups(member_list(spark, ["bad"], "o"), member_list(spark, ["tester"], "u"),
                    mapping_table(spark, {"mac": "DESKTOP"}), mapping_table(spark, {"D|mac": "Desktop"}), room_device_prefix="ROOM",
                    clients=mapping_table(spark, {"mac": "app"}), license_types=mapping_table(spark, {"m": "paid"}),
                    onboard_methods=mapping_table(spark, {"mac": "sync"}))
    j = job(spark, tmp_path, lookups=found, transforms={"src": lambda df, p: spark.createDataFrame(
        [("a", "u", "mac"), ("bad", "tester", None)], "o string, u string, ua string")}, sql={
        "flags": "SELECT o, validOrg(o) AS bad, testUser(u) AS test, uaCategory(ua) AS kind, ep1('D', ua) AS ep, "
                 "clientMapping(ua) AS c, onboardMethodMapping(ua) AS m, licenseMapping(ua) AS l FROM SOURCE_VIEW"})
    out = run_plan(j, [[step("src")], [step("flags")]])
    assert sorted(tuple(r) for r in out[0].frame.collect()) == [
        ("a", "0", 0, "DESKTOP", "Desktop", "app", "sync", "Unknown"), ("bad", "1", 1, "OTHER", "Other", "OTHER", "Unknown", "Unknown")]
    assert "activeUser" in j.transforms


def test_views_join_later(spark, tmp_path):
    j = job(spark, tmp_path, sql={
        "regions": "CREATE OR REPLACE TEMPORARY VIEW region_of AS SELECT orgId, region FROM SOURCE_VIEW;"
                   "CACHE LAZY TABLE region_of;",
        "users": "CREATE OR REPLACE TEMPORARY VIEW users AS SELECT orgId FROM SOURCE_VIEW; CACHE LAZY TABLE users;",
        "eu": "SELECT * FROM users LEFT SEMI JOIN region_of ON users.orgId = region_of.orgId AND region_of.region = 'EU'",
    }, transforms={
        "r": lambda df, p: spark.createDataFrame([("a", "EU"), ("b", "US")], "orgId string, region string"),
        "u": lambda df, p: spark.createDataFrame([("a",), ("b",), ("c",)], "orgId string")})
    out = run_plan(j, [[step("r")], [step("regions")], [step("u")], [step("users")], [step("eu")]])
    assert [r.orgId for r in out[0].frame.collect()] == ["a"]
    spark.catalog.clearCache()


def test_region_views_join_later(spark, tmp_path):
    """Regions, then users are set aside; after the first sink the reports have no input but those."""
    found = Lookups(member_list(spark, [], "o"), member_list(spark, [], "u"), mapping_table(spark, {}),
                    mapping_table(spark, {}), room_device_prefix="ROOM")
    j = job(spark, tmp_path, lookups=found, transforms={
        "r": lambda df, p: spark.createDataFrame([("a", "EU"), ("b", "US")], "orgId string, region string"),
        "u": lambda df, p: spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x")], "orgId string, pdate string")})
    write = {"queryName": "writeToFile", "parameters": {"dataLocation": str(tmp_path), "format": "json", "saveMode": "append"}}
    names = ["activeUserUS", "activeUserEU", "orgIdNoRegion"]
    stages = [[step("r")], [step("regionMapView")], [step("u")], [step("activeUserView")]]
    for name in names:
        stages += [[{"queryName": name, "parameters": {"output": name}}], [write]]
    run_plan(j, stages)
    got = [sorted(r.orgId for r in spark.read.json(str(tmp_path / name)).collect()) for name in names]
    assert got == [["b", "c"], ["a"], ["c"]]


def test_date_parameter_and_ids(spark):
    df = spark.createDataFrame([("2018-05-03",), ("2018-05-04",)], "d string")
    text = "CREATE OR REPLACE TEMPORARY VIEW v AS SELECT d, uuid(d) AS id FROM SOURCE_VIEW WHERE d = '$date'; SELECT * FROM v"
    rows = sql_stage(spark, text, df, {"date": "-1 days"}, run_day="2018-05-05").collect()
    assert [r.d for r in rows] == ["2018-05-04"] and len(rows[0].id) == 36


def test_lenient_and_ansi_rules(spark):
    df = spark.createDataFrame([("room", 1), (None, 0)], "s string, n int")
    text = "SELECT CASE WHEN s IS NOT NULL THEN s ELSE 0 END AS s, 10 / n AS q FROM SOURCE_VIEW ORDER BY s"
    assert [tuple(r) for r in sql_stage(spark, text, df).collect()] == [("0", None), ("room", 10.0)]
    with pytest.raises(Exception):
        sql_stage(spark, text, df, ansi=True).collect()
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_dedup_applies_to_the_view_before(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "n int, s string")
    text = """CREATE OR REPLACE TEMPORARY VIEW a AS SELECT n FROM SOURCE_VIEW WHERE n < 2;
              CREATE OR REPLACE TEMPORARY VIEW b AS DropDuplicates n; SELECT count(*) AS c FROM b"""
    assert sql_stage(spark, text, df).head().c == 1
    with pytest.raises(ValueError):
        sql_stage(spark, "CREATE OR REPLACE TEMPORARY VIEW b AS DropDuplicates n")


def test_sql_stage_filters_tags_and_parses(spark):
    sql_names.register(spark)
    df = spark.createDataFrame([('{"appname":"a","n":1,"timeRcvd":"2018-05-03"}',), ('{"appname":"b"}',)], "value string")
    text = ("SELECT convertTimeString(getTimestampField(value)) AS day, value, preprocess(value) AS plain "
            "FROM SOURCE_VIEW WHERE appFilter(value)")
    assert [r.day for r in sql_stage(spark, text, df, {"appName": "a"}).collect()] == ["2018-05-03"]
    parsed = sql_stage(spark, text, df, {"appName": "a", "schema": StructType.fromDDL("n INT")})
    assert parsed.columns == ["n", "raw"] and parsed.head().n == 1


def test_stream_job(spark, tmp_path):
    """The batch job's SQL on a file stream: the cut time carries the watermark."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "e.json").write_text("".join(
        json.dumps({"time_stamp": f"2018-05-0{d}T10:00:00Z", "userId": u}) + "\n" for d, u in [(3, "x"), (3, "x"), (4, "y")]))
    table = KeyedTable(fresh_path(spark, "agg"), "time_stamp TIMESTAMP, users BIGINT", ["time_stamp"])
    j = job(spark, tmp_path, mode="stream", tables={"agg": table}, schemas={
        "event": StructType.fromDDL("time_stamp STRING, userId STRING")}, sql={"count": """
        CREATE OR REPLACE TEMPORARY VIEW cut AS SELECT aggregateStartDate(time_stamp) AS time_stamp, userId FROM SOURCE_VIEW;
        CREATE OR REPLACE TEMPORARY VIEW once AS DropDuplicates time_stamp, userId;
        SELECT time_stamp, count(userId) AS users FROM once GROUP BY time_stamp"""})
    j.settings["spark"] = {"streamingCheckpointLocation": fresh_path(spark, "ck")}
    out = run_plan(j, [
        [step("readFromFile", input="in", format="json", schemaName="event", timeStampField="time_stamp",
              observation="times")],
        [step("count", aggregatePeriod="daily", timeStampField="time_stamp", output="count")],
        [step("writeToCassandra", cassandra={"table": "agg", "saveMode": "update"}, trigger=None)]])
    assert [r.query.name for r in out] == ["sinkToTable_count_daily"]
    out[0].query.awaitTermination()
    assert sorted(r.users for r in table.read(spark).collect()) == [1, 1]
    observed = [p["observedMetrics"]["times"] for p in out[0].query.recentProgress if p["observedMetrics"]]
    assert sum(m["rows"] for m in observed) == 3 and sum(m["unreadable_times"] for m in observed) == 0


def test_refusals(spark, tmp_path):
    j = job(spark, tmp_path, mode="stream", transforms={"t": lambda df, p: spark.range(1)})
    for sink in (step("deleteFromCassandra", cassandra={"table": "t"}), step("writeToHive", hive={"table": "t"}),
                 step("writeToOracle", oracle={"dbtable": "t"}, output="o")):
        with pytest.raises(ValueError):
            run_plan(j, [[step("t")], [sink]])
    for source in (step("readFromCassandra", cassandra={"table": "t"}), step("readFromOracle", oracle={"dbtable": "t"})):
        with pytest.raises(ValueError):
            run_plan(j, [[source]])
    with pytest.raises(ValueError):
        run_plan(j, [[step("writeToFile", format="json")]])
    with pytest.raises(ValueError):
        Job(spark, mode="Streaming")


def test_merged():
    assert merged({"a": {"b": 1, "c": 2}, "d": 3}, {"a": {"b": 9}, "e": 4}) == {"a": {"b": 9, "c": 2}, "d": 3, "e": 4}


def test_backfill_of_one_scan_has_the_rows_of_a_run_per_period(spark, tmp_path):
    rows = [(f"2024-01-{d:02d}", f"u{d % 5}", d) for d in range(1, 32) if d != 17]
    spark.createDataFrame(rows, "day string, user string, n long").withColumn("pdate", F.col("day")).write.partitionBy("pdate").parquet(
        str(tmp_path / "in"))
    start = F.date_format(times.period_start_day(F.col("day"), "weekly"), "yyyy-MM-dd")
    count = lambda df, p: df.groupBy(start.alias("week"), "user").agg(F.sum("n").alias("n"))
    job = jobs.Job(spark, settings={"dataLocation": str(tmp_path)}, transforms={"count": count})

    def run(one_scan, period="weekly", start_day="2024-01-10"):
        read = {"queryName": "readFromFile", "dateRange": {"startDate": start_day, "endDate": "2024-01-25", "oneScan": one_scan},
                "parameters": {"input": "in", "format": "parquet", "period": "weekly", "partitionKey": "pdate"}}
        return [r.frame for r in jobs.run_plan(job, [[read], [{"queryName": "count", "parameters": {"aggregatePeriod": period}}]])]

    many, [one] = run(False), run(True)
    assert len(many) == 3
    assert sorted(map(tuple, one.collect())) == sorted(tuple(r) for df in many for r in df.collect())
    with pytest.raises(ValueError):
        run(True, "monthly")


def test_monitors_are_steps(spark):
    facts = spark.sql("""SELECT * FROM VALUES ('a', '2024-01-16', 'callDuration', 'bc', 5L, 0D, 0), ('a', '2024-01-16', 'callQuality', 'x', 0L, 2D, 1),
        ('b', '2024-01-16', 'callDuration', 'bc', 9L, 0D, 0) AS t(orgid, pdate, relation_name, source, legduration, duration, audio_is_good)""")
    job = jobs.Job(spark, monitors=Monitors(["a"]), run_day="2024-01-17", transforms={"facts": lambda df, p: facts})
    [rows] = jobs.run_plan(job, [[{"queryName": "facts"}], [{"queryName": "durationMonitor", "parameters": {"rows": True}}]])
    assert [tuple(r) for r in rows.frame.collect()] == [("a", "2024-01-16", 5)]
    [sent] = jobs.run_plan(job, [[{"queryName": "facts"}], [{"queryName": "qualityMonitor"}]])
    message = sent.frame.first()
    assert (message.component, message.metrics.pipeLine, message.metrics.data.duration) == ("crs", "BCQuality", 2.0)
    [none] = jobs.run_plan(job, [[{"queryName": "facts"}], [{"queryName": "durationMonitor", "parameters": {"date": "2024-01-15", "rows": True}}]])
    assert none.frame.count() == 0
    own = jobs.Job(spark, monitors=Monitors(["a"]), transforms={"durationMonitor": lambda df, p: df})
    assert own.transforms["durationMonitor"](7, {}) == 7


def test_call_volume_model_and_monitor_are_steps(spark):
    calls = spark.sql("""SELECT org_id, day || 'T10:00:00.000Z' AS locus_start_time FROM VALUES ('A', '2024-01-10', 4), ('A', '2024-01-11', 4),
        ('A', '2024-01-12', 1), ('B', '2024-01-10', 2) AS t(org_id, day, n) LATERAL VIEW explode(sequence(1, n)) e AS i""")
    job = jobs.Job(spark, monitors=Monitors([]), transforms={"calls": lambda df, p: calls})
    averages = {"queryName": "callVolumeModel", "parameters": {"date": "2024-01-11", "orgNum": 5}}
    jobs.run_plan(job, [[{"queryName": "calls"}], [averages], [{"queryName": "callVolumeView"}]])
    alert = {"queryName": "callVolumeMonitor", "parameters": {"date": "2024-01-12", "threshold": 0.5, "rows": True}}
    [found] = jobs.run_plan(job, [[{"queryName": "calls"}], [alert]])
    assert {(r.org_id, r.currentAvg, r.historyAvg, r.status) for r in found.frame.collect()} == {("A", 1.0, 4.0, "true"), ("B", 0.0, 2.0, "true")}
    fresh = jobs.Job(spark, monitors=Monitors([]), transforms={"calls": lambda df, p: calls})
    with pytest.raises(ValueError):
        jobs.run_plan(fresh, [[{"queryName": "calls"}], [alert]])
