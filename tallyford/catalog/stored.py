"""Queries that write a table, a folder or a stream and read the result back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.times import period_start_day
from ..operators import periods
from ..operators.shaping import normalize_time
from ..plans.backfill import backfill
from ..plans.jobs import Job, run_plan
from ..session import fresh_path
from ..sinks.files import write_files
from ..sinks.tables import KeyedTable, insert_overwrite
from ..sinks.versions import VersionedFiles
from ..sources.files import read_period, stream_files
from ..streaming import sinks
from .aggregates import _ACTIVE, _START, VISITORS_SQL, VISITORS_TWIN
from .registry import query, table, with_text_time

_ORDERS = "o_orderkey BIGINT, pdate STRING, status STRING, price DOUBLE"


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy").alias("pdate"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"))


def _stored_orders(spark, sf):
    target = KeyedTable(fresh_path(spark, "orders"), _ORDERS, ["pdate", "o_orderkey"], ["pdate"])
    target.upsert(_orders(spark, sf))
    return target


@query("table_upsert", """
SELECT o_orderkey, strftime(o_orderdate, '%Y') AS pdate,
  CASE WHEN o_orderstatus = 'P' AND year(o_orderdate) = 1997 THEN 'F' ELSE o_orderstatus END AS status,
  o_totalprice AS price FROM orders""")
def table_upsert(spark, sf):
    target = _stored_orders(spark, sf)
    open_ = _orders(spark, sf).where((F.col("status") == "P") & (F.col("pdate") == "1997"))
    target.upsert(open_.select("pdate", "o_orderkey", F.lit("F").alias("status")))
    return target.read(spark)


@query("table_delete", """
SELECT o_orderkey, strftime(o_orderdate, '%Y') AS pdate, o_orderstatus AS status, o_totalprice AS price FROM orders
WHERE NOT (year(o_orderdate) = 1996 OR (year(o_orderdate) = 1997 AND o_orderstatus = 'P'))""")
def table_delete(spark, sf):
    target = _stored_orders(spark, sf)
    year = F.col("pdate")
    target.delete(_orders(spark, sf).where((year == "1996") | ((year == "1997") & (F.col("status") == "P"))))
    return target.read(spark)


@query("insert_overwrite", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END AS price, o_orderstatus AS status
FROM orders WHERE o_orderstatus <> 'F' OR o_totalprice > 200000""")
def overwritten(spark, sf):
    name = f"orders_{uuid.uuid4().hex}"
    ddl = (f"CREATE TABLE IF NOT EXISTS {name} (o_orderkey BIGINT, price DOUBLE, status STRING) USING ORC "
           f"OPTIONS (compression 'zlib') PARTITIONED BY (status) LOCATION '{fresh_path(spark, 'insert')}'")
    columns = ["o_orderkey", "price", "status"]
    insert_overwrite(_orders(spark, sf), name, columns, ddl)
    finished = _orders(spark, sf).where((F.col("status") == "F") & (F.col("price") > 200000))
    insert_overwrite(finished.withColumn("price", F.lit(0.0)), name, columns, ddl)
    return spark.table(name)


def _dated_events(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("pdate"))


@query("partitioned_files", """
SELECT strftime(ts, '%Y-%m-%d') AS pdate, count(*) AS events, count(DISTINCT user_id) AS users FROM events
WHERE ts::DATE BETWEEN DATE '2024-01-07' AND DATE '2024-01-13' GROUP BY 1""")
def partitioned_files(spark, sf):
    root = fresh_path(spark, "dated")
    write_files(_dated_events(spark, sf), f"{root}/events", "json", "append", "pdate")
    schema = StructType.fromDDL("event_id BIGINT, user_id BIGINT, pdate STRING")
    read = read_period(spark, root, "events", "json", "2024-01-10", "weekly", "pdate", schema, base_path=True)
    return read.groupBy("pdate").agg(F.count("event_id").alias("events"), F.count_distinct("user_id").alias("users"))


@query("backfill", """
SELECT strftime(ts::DATE - dayofweek(ts)::INT, '%Y-%m-%d') AS week, count(*) AS events,
  count(DISTINCT user_id) AS users FROM events
WHERE ts::DATE BETWEEN DATE '2024-01-07' AND DATE '2024-01-27' GROUP BY 1""")
def backfilled(spark, sf):
    path = fresh_path(spark, "backfill")
    write_files(_dated_events(spark, sf), path, "parquet", "append", "pdate")
    return backfill(
        spark, path, "parquet", "pdate", "2024-01-10", "2024-01-25", "weekly",
        lambda df: df.groupBy(F.date_format("period_start", "yyyy-MM-dd").alias("week")).agg(
            F.count("event_id").alias("events"), F.count_distinct("user_id").alias("users")))


_AGGREGATE = ("eventKey STRING, time_stamp TIMESTAMP, orgId STRING, userCountByOrg BIGINT, period STRING, "
              "relation_name STRING")


@query("job_plan", " UNION ALL ".join(
    VISITORS_TWIN.format(period=p, start=_START[p]).strip() for p in ("daily", "monthly")))
def job_plan(spark, sf):
    """A job: read, count per day and per month in SQL, merge both results into one keyed table."""
    schema = "time_stamp TIMESTAMP, kind STRING, period STRING, visitors BIGINT, odd_visitors BIGINT"
    target = KeyedTable(fresh_path(spark, "visitors"), schema, ["time_stamp", "kind", "period"])
    job = Job(
        spark, settings={"dataLocation": sf}, sql={"visitors": VISITORS_SQL}, tables={"visitors": target},
        transforms={"facts": lambda df, p: df.selectExpr(
            "CAST(ts AS TIMESTAMP) AS time_stamp", "event_type AS orgId", "user_id AS userId", "value")})
    count = {"queryName": "visitors", "parameters": {"timeStampField": "time_stamp", "output": "visitors"}}
    run_plan(job, [
        [{"queryName": "readFromFile", "parameters": {"input": "events.parquet", "format": "parquet"}}],
        [{"queryName": "facts"}],
        [merged_step(count, p) for p in ("daily", "monthly")] + [{"queryName": "missing", "disable": True}],
        [{"queryName": "writeToCassandra", "parameters": {"cassandra": {"table": "visitors", "saveMode": "update"}}}],
    ])
    return with_text_time(target.read(spark))


def merged_step(step: dict, period: str) -> dict:
    return {**step, "parameters": {**step["parameters"], "aggregatePeriod": period}}


def event_stream(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    # A glob finds the table whether it is one file or a folder of part files.
    stream = spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def drained(query_):
    query_.awaitTermination()


@query("stream_active_users", _ACTIVE.format(period="daily", start=_START["daily"]))
def stream_active_users(spark, sf):
    # A batch rewrites the periods it touches.
    target = KeyedTable(fresh_path(spark, "active"), _AGGREGATE, ["eventKey", "time_stamp"], ["time_stamp"])
    facts = event_stream(spark, sf).selectExpr("ts AS time_stamp", "event_type AS orgId", "user_id AS userId")
    counts = periods.distinct_count(facts, "daily", ["orgId"], "userId", "userCountByOrg", "activeUser")
    name = f"active_{uuid.uuid4().hex}"
    drained(sinks.to_keyed_table(counts, target, name, trigger=None))
    return with_text_time(target.read(spark))


@query("stream_distinct_tuples", """
SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day, user_id, event_type FROM events""")
def stream_distinct_tuples(spark, sf):
    path = fresh_path(spark, "tuples")
    rows = periods.cut(event_stream(spark, sf), "daily", ["user_id", "event_type"], "ts")
    rows = rows.dropDuplicates(["time_stamp", "user_id", "event_type"])
    rows = rows.withColumn("day", F.date_format("time_stamp", "yyyy-MM-dd")).drop("time_stamp")
    drained(sinks.to_files(rows, path, "parquet", f"tuples_{uuid.uuid4().hex}", trigger=None))
    return spark.read.parquet(path).select("day", "user_id", "event_type")


@query("stream_user_rollup", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS time_stamp, user_id, count(*) AS events,
  sum((event_type = 'click')::INT)::BIGINT AS clicks FROM events GROUP BY 1, 2""")
def stream_user_rollup(spark, sf):
    target = KeyedTable(
        fresh_path(spark, "rollup"), "time_stamp TIMESTAMP, user_id BIGINT, events BIGINT, clicks BIGINT",
        ["time_stamp", "user_id"])
    rows = periods.cut(event_stream(spark, sf), "daily", ["user_id", "event_type"], "ts").groupBy(
        "time_stamp", "user_id").agg(
        F.count(F.lit(1)).alias("events"), F.sum((F.col("event_type") == "click").cast("bigint")).alias("clicks"))
    drained(sinks.to_keyed_table(rows, target, f"rollup_{uuid.uuid4().hex}", trigger=None))
    return with_text_time(target.read(spark))


_ROLLUP = ("time_stamp", "user_id")


@query("stream_files_update", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS time_stamp, user_id, count(*) AS events,
  count(DISTINCT event_type) AS kinds FROM events GROUP BY 1, 2""")
def stream_files_update(spark, sf):
    """Counts that later events raise, as files: each batch rewrites the days it touches. One file of the table makes a batch."""
    path, name = fresh_path(spark, "updates"), f"updates_{uuid.uuid4().hex}"
    rows = periods.cut(event_stream(spark, sf), "daily", ["user_id", "event_type"], "ts").groupBy(*_ROLLUP).agg(
        F.count(F.lit(1)).alias("events"), F.size(F.collect_set("event_type")).cast("bigint").alias("kinds"))
    drained(sinks.to_files(rows, path, "parquet", name, "update", "time_stamp", trigger=None, keys=_ROLLUP))
    return with_text_time(VersionedFiles(path).read(spark))


@query("stream_files_complete", """
SELECT event_type, count(*) AS events, max(value) AS most FROM events GROUP BY 1""")
def stream_files_complete(spark, sf):
    path, name = fresh_path(spark, "complete"), f"complete_{uuid.uuid4().hex}"
    rows = event_stream(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.max("value").alias("most"))
    drained(sinks.to_files(rows, path, "parquet", name, "complete", trigger=None))
    return VersionedFiles(path).read(spark)


@query("job_backfill", """
SELECT strftime(ts::DATE - dayofweek(ts)::INT, '%Y-%m-%d') AS week, event_type AS kind, count(*) AS events,
  count(DISTINCT user_id) AS users FROM events
WHERE ts::DATE BETWEEN DATE '2024-01-07' AND DATE '2024-01-27' GROUP BY 1, 2""")
def job_backfill(spark, sf):
    """A job over three weeks of dated files, which one scan reads; the weeks stay apart by their start."""
    root = fresh_path(spark, "dated")
    write_files(_dated_events(spark, sf).withColumn("day", F.col("pdate")), f"{root}/events", "parquet", "append", "pdate")
    week = F.date_format(period_start_day(F.col("day"), "weekly"), "yyyy-MM-dd")
    job = Job(spark, settings={"dataLocation": root}, transforms={"weeks": lambda df, p: df.groupBy(
        week.alias("week"), F.col("event_type").alias("kind")).agg(
        F.count("event_id").alias("events"), F.count_distinct("user_id").alias("users"))})
    read = {"queryName": "readFromFile", "dateRange": {"startDate": "2024-01-10", "endDate": "2024-01-25", "oneScan": True},
            "parameters": {"input": "events", "format": "parquet", "period": "weekly", "partitionKey": "pdate"}}
    [made] = run_plan(job, [[read], [{"queryName": "weeks", "parameters": {"aggregatePeriod": "weekly"}}]])
    return made.frame


@query("stream_chain", _ACTIVE.format(period="weekly", start=_START["weekly"]))
def stream_chain(spark, sf):
    """Two streams, one behind the other: facts become messages of a topic, for which a folder stands in, and the second stream counts them.

    Each has a checkpoint of its own. Both are started again where they left off, which changes nothing.
    """
    root, name = fresh_path(spark, "chain"), uuid.uuid4().hex
    target = KeyedTable(f"{root}/counts", _AGGREGATE, ["eventKey", "time_stamp"], ["time_stamp"])
    facts = event_stream(spark, sf).selectExpr(
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\") AS time_stamp", "event_type AS orgId", "CAST(user_id AS STRING) AS userId")
    schema = StructType.fromDDL("time_stamp STRING, orgId STRING, userId STRING")
    for _ in range(2):
        drained(sinks.to_files(facts, f"{root}/facts", "json", f"facts_{name}", trigger=None, checkpoint_root=f"{root}/checkpoints"))
        rows = normalize_time(stream_files(spark, root, "facts", "json", schema), "time_stamp")
        counts = periods.distinct_count(rows, "weekly", ["orgId"], "userId", "userCountByOrg", "activeUser")
        drained(sinks.to_keyed_table(counts, target, f"counts_{name}", trigger=None, checkpoint_root=f"{root}/checkpoints"))
    return with_text_time(target.read(spark))
