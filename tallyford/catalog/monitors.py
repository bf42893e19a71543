"""The monitors, on usage tables derived from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..monitors import call_volume, common, devices, licences, tables, volume
from ..functions.times import add_days
from ..plans.jobs import Job, run_plan
from ..plans.monitor_steps import Monitors
from ..session import fresh_path
from .registry import query, table, with_text_time

ORGS = ["AF", "AO", "NF", "NO", "RF"]
BUSINESS_DAY, DAY_OFF = "1998-06-15", "1998-06-14"


def usage_aggregates(spark, sf):
    """Daily aggregates of five relations per organisation, from line items."""
    return aggregates_of(table(spark, sf, "lineitem"))


def aggregates_of(items, *more):
    """The same of given items; `more` columns may use the day's quantity `q` and count `n`."""
    per_day = items.groupBy(
        F.concat("l_returnflag", "l_linestatus").alias("orgid"), F.col("l_shipdate").alias("time_stamp")).agg(
        F.sum("l_quantity").cast("bigint").alias("q"), F.count(F.lit(1)).alias("n"))
    cells = F.array(*[F.lit(r) for r in volume.COUNTED])
    rows = per_day.select("*", F.explode(cells).alias("relation_name"))
    relation = F.col("relation_name")
    none = F.lit(None).cast("bigint")
    return rows.select(
        "orgid", "relation_name", "time_stamp", F.lit("daily").alias("period"),
        F.when(relation == "fileUsed", F.col("q") * 2).otherwise(none).alias("files"),
        F.when(relation == "activeUser", F.col("q") * 10).otherwise(none).alias("usercountbyorg"),
        F.when(relation == "messageSent", F.col("q") * 3).otherwise(none).alias("messages"),
        F.when(F.col("n") % 2 == 0, "DESKTOP").otherwise("MOBILE").alias("ua_category"),
        F.when(F.col("n") % 3 == 0, "Web").otherwise("Desktop").alias("ep1"),
        F.when(relation == "callDuration", F.col("q") * 5).otherwise(none).alias("number_of_successful_calls"),
        F.when(relation == "callQuality", F.col("q") * 4).otherwise(none).alias("number_of_total_calls"),
        F.when(relation == "callQuality", F.col("n")).otherwise(none).alias("number_of_bad_calls"), *more)


_AGG = """
WITH d AS (SELECT l_returnflag || l_linestatus AS orgid, strftime(l_shipdate, '%Y-%m-%d') AS pdate,
    l_shipdate::DATE AS dt, sum(l_quantity)::BIGINT AS q, count(*) AS n FROM lineitem GROUP BY ALL),
c AS (
  SELECT 'orgCount' AS orgid, r AS relation_name, pdate, dt, count(*) AS "count" FROM d,
    (SELECT unnest(['fileUsed', 'activeUser', 'callDuration', 'callQuality', 'messageSent']) AS r) GROUP BY ALL
  UNION ALL SELECT 'orgCount', r, '{day}', DATE '{day}', 0 FROM (SELECT unnest(
      ['fileUsed', 'activeUser', 'callDuration', 'callQuality', 'messageSent']) AS r)
    WHERE NOT EXISTS (SELECT 1 FROM d WHERE pdate = '{day}')
  UNION ALL SELECT orgid, 'fileUsed', pdate, dt, q * 2 FROM d WHERE orgid <> 'RO'
  UNION ALL SELECT orgid, 'activeUser', pdate, dt, q * 10 FROM d WHERE orgid <> 'RO'
  UNION ALL SELECT orgid, 'messageSent', pdate, dt, q * 3 FROM d WHERE orgid <> 'RO' AND n % 2 = 0
  UNION ALL SELECT orgid, 'number_of_total_calls', pdate, dt, q * 5 FROM d WHERE orgid <> 'RO' AND n % 3 <> 0
  UNION ALL SELECT orgid, 'number_of_good_calls', pdate, dt, q * 4 - n FROM d WHERE orgid <> 'RO'),
a AS (SELECT orgid, relation_name, avg("count") AS avg FROM c
  WHERE dt > DATE '{day}' - 64 AND dt < DATE '{day}' AND {like} GROUP BY ALL)
SELECT c.orgid, c.relation_name, pdate, "count", round(avg, 6) AS avg, trunc("count" / avg * 100)::INT AS percentage,
  CASE WHEN (CASE WHEN c.relation_name = 'activeUser' THEN avg > 800 ELSE avg > 100 END)
    AND ((c.relation_name IN ('fileUsed', 'callDuration', 'messageSent', 'number_of_good_calls') AND "count" = 0)
      OR (c.relation_name IN ('activeUser', 'number_of_total_calls')
        AND ("count" / avg < 0.5 OR "count" / avg > 4)))
    THEN 'failure' ELSE 'success' END AS status
FROM c JOIN a ON c.orgid = a.orgid AND c.relation_name = a.relation_name WHERE pdate = '{day}'"""
_HOLIDAYS = "strftime(dt, '%m-%d') NOT IN ('07-04') AND NOT (month(dt) = 5 AND dayofweek(dt) = 1 AND day(dt) > 24)"
_BUSINESS = f"(dayofweek(dt) NOT IN (0, 6) AND {_HOLIDAYS})"


def _volume(spark, sf, day):
    rows = volume.run(usage_aggregates(spark, sf), ORGS, day, 0.5)
    return rows.withColumn("avg", F.round("avg", 6))


@query("volume_monitor", _AGG.format(day=BUSINESS_DAY, like=_BUSINESS))
def volume_monitor(spark, sf):
    return _volume(spark, sf, BUSINESS_DAY)


@query("volume_monitor_day_off", _AGG.format(day=DAY_OFF, like=f"NOT {_BUSINESS}"))
def volume_monitor_day_off(spark, sf):
    return _volume(spark, sf, DAY_OFF)


@query("volume_messages", f"""SELECT 'crs' AS component, 'metrics' AS eventtype, pdate || 'T00:00:00Z' AS "sendTime",
  orgid || '_' || relation_name AS name, "count" AS volume, status
FROM ({_AGG.format(day=BUSINESS_DAY, like=_BUSINESS)})""")
def volume_messages(spark, sf):
    return volume.messages(_volume(spark, sf, BUSINESS_DAY)).select(
        "component", "eventtype", "metrics.sendTime", "metrics.data.name", "metrics.data.volume", "metrics.data.status")


@query("license_monitor", """
WITH l AS (SELECT event_type AS orgid, ts::DATE AS dt, user_id FROM events
  WHERE event_type IN ('click', 'view', 'signup') AND CAST(json_extract_string(props, '$.k') AS INT) % 3 <> 0),
d AS (SELECT orgid, dt, count(DISTINCT user_id) AS n FROM l GROUP BY 1, 2)
SELECT orgid, '2024-01-24' AS pdate, max(n) FILTER (dt = DATE '2024-01-24') AS "licenseCount", true AS "isBusinessDay",
  trunc(avg(n) FILTER (dt > DATE '2024-01-24' - 33 AND dt < DATE '2024-01-24' AND dayofweek(dt) NOT IN (0, 6)
    AND strftime(dt, '%m-%d') NOT IN ('01-01', '12-24', '12-25')))::INT AS avg
FROM d GROUP BY 1""")
def license_monitor(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    events = common.within(table(spark, sf, "events"), "ts", "2024-01-24", licences.HISTORY_DAYS)
    facts = events.select(
        F.col("event_type").alias("orgid"), F.col("user_id").alias("userid"),
        F.date_format("ts", "yyyy-MM-dd").alias("pdate"), F.lit("license").alias("relation_name"),
        F.when(k % 3 != 0, "SUCCESS").otherwise("FAILED").alias("status"))
    return licences.run(facts, ["click", "view", "signup"], "2024-01-24")


_USAGE = """
WITH d AS (SELECT 'p' || (l_partkey % 20) AS orgid, l_shipdate::DATE AS dt, count(DISTINCT l_suppkey) AS dev,
    sum(l_quantity) AS incall, sum(l_linenumber)::DOUBLE AS cable, sum(l_quantity * 2) AS wireless,
    sum(l_linenumber * 10)::DOUBLE AS whiteboard
  FROM lineitem WHERE l_partkey % 20 < 18 GROUP BY 1, 2),
v AS (SELECT orgid, dt, dev, incall / dev AS incall, cable / dev AS cable, wireless / dev AS wireless,
    whiteboard / dev AS whiteboard FROM d),
a AS (SELECT orgid, trunc(avg(incall))::INT AS "incallAvg", trunc(avg(cable))::INT AS "cableAvg",
    trunc(avg(wireless))::INT AS "wirelessAvg", trunc(avg(whiteboard))::INT AS "whiteboardAvg"
  FROM v WHERE dt > DATE '1998-06-15' - 30 AND dt < DATE '1998-06-15' GROUP BY 1),
j AS (SELECT v.orgid, '1998-06-15' AS pdate, dev AS "deviceCount", round(incall, 6) AS incall, round(cable, 6) AS cable,
    round(wireless, 6) AS wireless, round(whiteboard, 6) AS whiteboard, "incallAvg", "cableAvg", "wirelessAvg",
    "whiteboardAvg",
    trunc((incall - "incallAvg") / nullif("incallAvg", 0) * 100)::INT AS "incallDiffPctg",
    trunc((cable - "cableAvg") / nullif("cableAvg", 0) * 100)::INT AS "cableDiffPctg",
    trunc((wireless - "wirelessAvg") / nullif("wirelessAvg", 0) * 100)::INT AS "wirelessDiffPctg",
    trunc((whiteboard - "whiteboardAvg") / nullif("whiteboardAvg", 0) * 100)::INT AS "whiteboardDiffPctg",
    incall BETWEEN "incallAvg" * 0.5 AND "incallAvg" * 1.5 AND cable BETWEEN "cableAvg" * 0.5 AND "cableAvg" * 1.5
      AND wireless BETWEEN "wirelessAvg" * 0.5 AND "wirelessAvg" * 1.5
      AND whiteboard BETWEEN "whiteboardAvg" * 0.5 AND "whiteboardAvg" * 1.5 AS normal
  FROM v JOIN a ON v.orgid = a.orgid WHERE dt = DATE '1998-06-15')"""


def _usage(spark, sf):
    items = common.within(table(spark, sf, "lineitem"), "l_shipdate", BUSINESS_DAY, devices.HISTORY_DAYS)
    rows = items.select(
        F.concat(F.lit("p"), F.col("l_partkey") % 20).alias("orgid"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("pdate"), F.col("l_suppkey").alias("deviceid"), F.col("l_quantity").alias("incall"),
        F.col("l_linenumber").alias("local_share_cable"), (F.col("l_quantity") * 2).alias("local_share_wireless"),
        (F.col("l_linenumber") * 10).alias("white_boarding"))
    return devices.run(rows, [f"p{i}" for i in range(18)], BUSINESS_DAY)


def _rounded(rows):
    return rows.withColumns({name: F.round(name, 6) for name in devices.MEASURES})


@query("usage_anomaly", f"{_USAGE} SELECT * EXCLUDE (normal) FROM j WHERE NOT coalesce(normal, false)")
def usage_anomaly(spark, sf):
    return _rounded(devices.anomalies(_usage(spark, sf), 0.5))


@query("usage_normal", f"{_USAGE} SELECT * EXCLUDE (normal) FROM j WHERE normal")
def usage_normal(spark, sf):
    return _rounded(devices.normal_rows(_usage(spark, sf), 0.5))


def usage_facts(spark, sf):
    """Facts of several relations of one day, from line items."""
    kind = F.col("l_linenumber") % 3
    return common.within(table(spark, sf, "lineitem"), "l_shipdate", BUSINESS_DAY).select(
        F.concat("l_returnflag", "l_linestatus").alias("orgid"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("pdate"),
        F.when(kind == 0, "callDuration").when(kind == 1, "callQuality").otherwise("rtUser").alias("relation_name"),
        F.when(F.col("l_suppkey") % 2 == 0, "bc").otherwise("other").alias("source"),
        F.lit(1).alias("iscall"), F.col("l_linenumber").alias("ismessage"), F.col("l_partkey").alias("legduration"),
        F.col("l_quantity").alias("duration"), (F.col("l_quantity") > 25).cast("int").alias("audio_is_good"),
        F.col("l_orderkey").alias("contentsize"), F.lit(0).alias("isfile"),
        F.when(F.col("l_tax") > 0.04, F.col("l_partkey").cast("string")).alias("group"),
        F.col("l_linenumber").alias("videotime"))


_FACTS = """
WITH f AS (SELECT l_returnflag || l_linestatus AS orgid, strftime(l_shipdate, '%Y-%m-%d') AS pdate,
  CASE l_linenumber % 3 WHEN 0 THEN 'callDuration' WHEN 1 THEN 'callQuality' ELSE 'rtUser' END AS relation_name, *
  FROM lineitem WHERE strftime(l_shipdate, '%Y-%m-%d') = '1998-06-15' AND l_returnflag || l_linestatus <> 'RO')"""


@query("table_monitor", f"""{_FACTS}
SELECT relation_name, orgid, pdate, count(*) AS call, sum(l_linenumber)::BIGINT AS message,
  sum(l_partkey)::BIGINT AS legduration, sum(l_quantity) AS duration,
  sum((l_quantity > 25)::INT)::BIGINT AS audio_is_good, sum(l_orderkey)::BIGINT AS contentsize, 0::BIGINT AS isfile,
  count(*) FILTER (l_tax > 0.04) AS number_of_groups, sum(l_linenumber)::BIGINT AS videotime, 'EU' AS region
FROM f GROUP BY 1, 2, 3""")
def table_monitor(spark, sf):
    return tables.data_sums(usage_facts(spark, sf), ORGS, BUSINESS_DAY, "EU")


@query("aggregate_monitor", """
WITH d AS (SELECT l_returnflag || l_linestatus AS orgid, sum(l_quantity)::BIGINT AS q, count(*) AS n
  FROM lineitem WHERE l_shipdate::DATE = DATE '1998-06-15' GROUP BY 1)
SELECT r AS relation_name, orgid, '1998-06-15 00:00:00' AS time_stamp,
  CASE WHEN r = 'activeUser' THEN q * 10 END AS usercountbyorg,
  CASE WHEN r = 'callDuration' THEN q * 5 END AS successful_calls, CASE WHEN r = 'callQuality' THEN n END AS bad_calls,
  CASE WHEN r = 'callQuality' THEN q * 4 END AS total_calls, CASE WHEN r = 'fileUsed' THEN q * 2 END AS files,
  1::BIGINT AS number_of_ua_category, CASE WHEN r = 'messageSent' THEN q * 3 END AS messages,
  CASE WHEN r = 'messageSent' THEN q * 3 END AS message, 1::BIGINT AS number_of_userid,
  CASE WHEN r = 'activeUser' THEN n END AS onetoonecount, CASE WHEN r = 'activeUser' THEN n + 1 END AS spacecount,
  CASE WHEN r = 'callDuration' THEN q * 6 END AS minutes, CASE WHEN r = 'fileUsed' THEN q * 7 END AS filesize,
  CASE WHEN r = 'callDuration' THEN n * 2 END AS calls, 'EU' AS region
FROM d, (SELECT unnest(['fileUsed', 'activeUser', 'callDuration', 'callQuality', 'messageSent']) AS r)
WHERE orgid <> 'RO'""")
def aggregate_monitor(spark, sf):
    def of(relation, value, name):
        return F.when(F.col("relation_name") == relation, value).alias(name)

    q, n = F.col("q"), F.col("n")
    rows = aggregates_of(
        table(spark, sf, "lineitem"), of("activeUser", n, "onetoonecount"), of("activeUser", n + 1, "spacecount"),
        of("callDuration", q * 6, "number_of_minutes"), of("fileUsed", q * 7, "filesize"), of("callDuration", n * 2, "calls"),
        F.col("orgid").alias("userid"))
    return with_text_time(tables.aggregate_sums(rows, ORGS, BUSINESS_DAY, "EU"))


@query("daily_sums", f"""{_FACTS}
SELECT 'duration' AS kind, orgid, pdate, sum(l_partkey)::BIGINT::DOUBLE AS total, CAST(NULL AS BIGINT) AS audio_is_good
FROM f WHERE relation_name = 'callDuration' AND l_suppkey % 2 = 0 GROUP BY 1, 2, 3
UNION ALL SELECT 'quality', orgid, pdate, sum(l_quantity), sum((l_quantity > 25)::INT)::BIGINT
FROM f WHERE relation_name = 'callQuality' GROUP BY 1, 2, 3""")
def daily_sums(spark, sf):
    return tables.daily_sums(usage_facts(spark, sf), ORGS, BUSINESS_DAY)


def call_records(spark, sf):
    return common.within(table(spark, sf, "events"), "ts", "2024-01-24", call_volume.HISTORY_DAYS).select(
        F.concat(F.lit("o"), F.col("user_id") % 30).alias("org_id"),
        F.when(F.col("event_id") % 20 == 0, "unreadable").otherwise(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).alias("locus_start_time"))


_MODEL = """
WITH r AS (SELECT 'o' || (user_id % 30) AS org_id, ts::DATE AS dt FROM events WHERE event_id % 20 <> 0),
d AS (SELECT org_id, dt, count(*) AS n FROM r GROUP BY 1, 2),
m AS (SELECT org_id, avg(n) AS avg FROM d WHERE dt > DATE '2024-01-25' - 31 AND dt < DATE '2024-01-25'
  AND dayofweek(dt) NOT IN (0, 6) AND strftime(dt, '%m-%d') <> '01-01' GROUP BY 1 ORDER BY avg DESC, org_id LIMIT 12)"""


@query("call_volume_model", f"{_MODEL} SELECT org_id, round(avg, 6) AS avg FROM m")
def call_volume_model(spark, sf):
    rows = call_volume.model(call_records(spark, sf), "2024-01-25", orgs=12)
    return rows.withColumn("avg", F.round("avg", 6))


@query("call_volume_alert", f"""{_MODEL}
SELECT m.org_id, coalesce(n, 0)::DOUBLE AS "currentAvg", round(avg, 6) AS "historyAvg",
  trunc(coalesce(n, 0) / avg * 100)::INT AS percentage, '2024-01-24' AS "eventTime", '0.8' AS threshold,
  CASE WHEN coalesce(n, 0) / avg < 0.8 OR coalesce(n, 0) / avg > 2.5 THEN 'true' ELSE 'false' END AS status
FROM m LEFT JOIN (SELECT * FROM d WHERE dt = DATE '2024-01-24') t ON m.org_id = t.org_id""")
def call_volume_alert(spark, sf):
    calls = call_records(spark, sf)
    stored = fresh_path(spark, "model")
    call_volume.model(calls, "2024-01-25", orgs=12).write.parquet(stored)
    rows = call_volume.alerts(calls, spark.read.parquet(stored), "2024-01-24", 0.8, orgs=12).drop("eventTimestamp")
    return rows.withColumn("historyAvg", F.round("historyAvg", 6))


@query("job_monitor", f"""SELECT 'crs' AS component, 'metrics' AS eventtype, 'Spark' AS "pipeLine", 'DataProcess' AS phase,
  pdate || 'T00:00:00Z' AS "sendTime", orgid || '_' || relation_name AS name, pdate AS "reportDate", orgid, relation_name AS type,
  "count" AS volume, avg AS "historicalAverageVolume", percentage, status
FROM ({_AGG.format(day=BUSINESS_DAY, like=_BUSINESS)})""")
def job_monitor(spark, sf):
    """The volume monitor as a job: aggregates, monitor, a sink for its messages."""
    root = fresh_path(spark, "messages")
    job = Job(
        spark, settings={"dataLocation": sf}, monitors=Monitors(ORGS), run_day=add_days(BUSINESS_DAY, 1),
        transforms={"aggregates": lambda df, p: aggregates_of(df.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp")))})
    run_plan(job, [
        [{"queryName": "readFromFile", "parameters": {"input": "lineitem.parquet", "format": "parquet"}}],
        [{"queryName": "aggregates"}],
        [{"queryName": "volumeMonitor", "parameters": {"threshold": 0.5}}],
        [{"queryName": "writeToFile", "parameters": {"dataLocation": root, "output": "volume", "format": "parquet", "saveMode": "append"}}],
    ])
    sent = spark.read.parquet(f"{root}/volume")
    return sent.select("component", "eventtype", "metrics.pipeLine", "metrics.phase", "metrics.sendTime", "metrics.data.*").withColumn(
        "historicalAverageVolume", F.round("historicalAverageVolume", 6))
