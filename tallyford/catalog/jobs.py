"""Queries that run jobs, their SQL texts and files, and streams of files."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import sql_names
from ..functions.times import period_start_day
from ..operators.lookups import literal_rows, look_up, read_mapping
from ..operators.shaping import has_column
from ..plans.jobs import Job, load_job, run_plan
from ..plans.sql_stage import sql_stage
from ..session import fresh_path
from ..sinks.files import write_files, write_summary
from ..sinks.tables import KeyedTable, create_bucketed_table
from ..sources.files import read_files, stream_files, stream_period
from ..streaming import sinks
from ..streaming.progress import watch
from .registry import query, table
from .stored import drained, event_stream

_READ_EVENTS = [{"queryName": "readFromFile", "parameters": {"input": "events.parquet", "format": "parquet"}}]


def _text_file(spark, path, text):
    """A text as one file of a folder."""
    literal_rows(spark, {"value": [text]}).coalesce(1).write.text(path)


@query("job_output_names", """
SELECT 'daily' AS period, strftime(ts, '%Y-%m-%d') AS start, event_type AS kind, count(*) AS events FROM events GROUP BY 2, 3
UNION ALL
SELECT 'monthly', strftime(date_trunc('month', ts), '%Y-%m-%d'), event_type, count(*) FROM events GROUP BY 2, 3""")
def job_output_names(spark, sf):
    """One sink after two counts: each result goes to the folder named by its count and period, not by the sink."""
    root = fresh_path(spark, "named")

    def counts(df, p):
        start = period_start_day(F.date_format("ts", "yyyy-MM-dd"), p["aggregatePeriod"])
        return df.groupBy(F.date_format(start, "yyyy-MM-dd").alias("start"), F.col("event_type").alias("kind")).agg(
            F.count(F.lit(1)).alias("events"))

    job = Job(spark, settings={"dataLocation": sf}, transforms={"counts": counts})
    run_plan(job, [
        _READ_EVENTS,
        [{"queryName": "counts", "parameters": {"output": "counts", "aggregatePeriod": p}} for p in ("daily", "monthly")],
        [{"queryName": "writeToFile", "parameters": {
            "dataLocation": root, "output": "unused", "format": "parquet", "saveMode": "overwrite"}}]])
    named = [read_files(spark, root, f"counts_{p}", "parquet").withColumn("period", F.lit(p)) for p in ("daily", "monthly")]
    assert read_files(spark, root, "unused", "parquet") is None
    return named[0].unionByName(named[1])


_SINCE_SQL = """
CREATE TEMP VIEW recent AS SELECT event_type AS kind, user_id FROM SOURCE_VIEW WHERE date_format(ts, 'yyyy-MM-dd') >= '$date';
SELECT kind, count(*) AS events, count(DISTINCT user_id) AS users FROM recent GROUP BY kind
"""


@query("job_relative_date", """
SELECT event_type AS kind, count(*) AS events, count(DISTINCT user_id) AS users FROM events
WHERE ts::DATE >= DATE '2024-01-17' GROUP BY 1""")
def job_relative_date(spark, sf):
    """A job file and a SQL file in the shared folder; `$date` is three days before the run day."""
    root = fresh_path(spark, "job")
    _text_file(spark, f"{root}/sql/since", _SINCE_SQL)
    _text_file(spark, f"{root}/job.json", json.dumps(
        {"queryPlan": [_READ_EVENTS, [{"queryName": "since", "parameters": {"date": "-3 days"}}]]}, indent=1))
    job = Job(spark, settings={"dataLocation": sf, "queryLocation": f"{root}/sql"}, run_day="2024-01-20")
    [made] = run_plan(job, load_job(spark, f"{root}/job.json"))
    return made.frame


@query("job_cached_view", """
WITH u AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
SELECT n AS events, count(*) AS users FROM u WHERE n > (SELECT avg(n) FROM u) GROUP BY 1""")
def job_cached_view(spark, sf):
    """A view that a later statement reads twice, kept once it is read; a new view of its name lets it go. The plan shows a preview."""
    job = Job(spark, settings={"dataLocation": sf}, preview=1, sql={
        "busy": "CREATE OR REPLACE TEMP VIEW user_events AS SELECT user_id, count(*) AS n FROM SOURCE_VIEW GROUP BY user_id;"
                "CACHE LAZY TABLE user_events;"
                "SELECT n AS events, count(*) AS users FROM user_events WHERE n > (SELECT avg(n) FROM user_events) GROUP BY n"})
    [made] = run_plan(job, [_READ_EVENTS, [{"queryName": "busy"}]])
    return made.frame


@query("job_schema", "SELECT event_id, user_id, event_type, value AS amount FROM events WHERE event_type = 'click'")
def job_schema(spark, sf):
    """A SQL step over JSON texts, whose result is parsed with the schema the step names."""
    text = F.to_json(F.struct("event_id", "user_id", "event_type", F.col("value").alias("amount"))).alias("value")
    job = Job(spark, settings={"dataLocation": sf}, transforms={"as_text": lambda df, p: df.select(text)}, sql={
        "clicks": "SELECT value FROM SOURCE_VIEW WHERE get_json_object(value, '$.event_type') = 'click'"}, schemas={
        "event": StructType.fromDDL("event_id BIGINT, user_id BIGINT, event_type STRING, amount DOUBLE")})
    [made] = run_plan(job, [_READ_EVENTS, [{"queryName": "as_text"}],
                            [{"queryName": "clicks", "parameters": {"schemaName": "event"}}]])
    return made.frame.drop("raw")


@query("column_paths", """
SELECT event_type AS kind, true AS top, true AS inner_path, false AS missing, false AS below_leaf, count(*) AS events
FROM events GROUP BY 1""")
def column_paths(spark, sf):
    df = table(spark, sf, "events").select(F.struct(F.col("event_type").alias("kind"), "user_id").alias("event"))
    found = {"top": "event", "inner_path": "event.kind", "missing": "event.none", "below_leaf": "event.kind.none"}
    return df.groupBy(F.col("event.kind").alias("kind"), *[F.lit(has_column(df, p)).alias(n) for n, p in found.items()]).agg(
        F.count(F.lit(1)).alias("events"))


@query("mapping_file", """
SELECT coalesce(r.r_name, 'OTHER') AS client, coalesce(r.r_name, 'Unknown') AS licence, coalesce(r.r_name, 'none') AS looked_up,
  count(*) AS customers
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region r ON r_regionkey = n_regionkey AND r_name <> 'ASIA'
GROUP BY 1, 2, 3""")
def mapping_file(spark, sf):
    """A mapping kept as CSV, as functions of a SQL text and as a lookup; nations it leaves out get each one's default."""
    root = fresh_path(spark, "mapping")
    nations = table(spark, sf, "nation")
    known = nations.join(table(spark, sf, "region").where("r_name <> 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    write_files(known.select("n_name", "r_name"), root, "csv", "overwrite")
    mapping = read_mapping(spark, root)
    for name in ("clientMapping", "licenseMapping"):
        sql_names.register_mapping(spark, name, mapping)
    named = table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name")
    mapped = sql_stage(spark, "SELECT n_name, clientMapping(n_name) AS client, licenseMapping(n_name) AS licence FROM SOURCE_VIEW", named)
    return look_up(mapped, mapping, "n_name", "looked_up", "none").groupBy("client", "licence", "looked_up").agg(
        F.count(F.lit(1)).alias("customers"))


@query("bucketed_table", """
SELECT o_orderstatus AS status, count(*) AS orders, count(DISTINCT o_custkey) AS customers, max(o_totalprice) AS most
FROM orders GROUP BY 1""")
def bucketed_table(spark, sf):
    """A table made from a frame's columns, bucketed by customer and sorted by order, then filled."""
    name = f"orders_{uuid.uuid4().hex}"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    create_bucketed_table(orders, name, "o_custkey", "o_orderkey", 8)
    orders.write.insertInto(name)
    return spark.table(name).groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("orders"), F.count_distinct("o_custkey").alias("customers"), F.max("o_totalprice").alias("most"))


@query("summary_file", "SELECT event_type AS kind, count(*) AS events, max(value) AS most FROM events GROUP BY 1")
def summary_file(spark, sf):
    path = fresh_path(spark, "summary")
    write_summary(table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)), F.max("value")), path)
    return spark.read.schema("kind STRING, events BIGINT, most DOUBLE").csv(path)


@query("stream_catalog_table", "SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'view'")
def stream_catalog_table(spark, sf):
    name = f"events_{uuid.uuid4().hex}"
    rows = event_stream(spark, sf).where("event_type <> 'view'").select("event_id", "user_id", "event_type")
    drained(sinks.to_catalog_table(rows, name, name, trigger=None))
    return spark.table(name)


_KINDS = "kind STRING, events BIGINT"


def _kinds(df):
    return df.groupBy(F.col("event_type").alias("kind")).agg(F.count(F.lit(1)).alias("events"))


@query("stream_dated_files", """
SELECT event_type AS kind, count(*) AS events FROM events
WHERE ts::DATE BETWEEN DATE '2024-01-07' AND DATE '2024-01-13' GROUP BY 1""")
def stream_dated_files(spark, sf):
    """The dated folders of a week as a stream."""
    root, name = fresh_path(spark, "dated"), f"dated_{uuid.uuid4().hex}"
    events = table(spark, sf, "events").select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("pdate"))
    write_files(events, f"{root}/events", "json", "append", "pdate")
    rows = stream_period(spark, root, "events", "json", "2024-01-10", "weekly", "pdate", schema=StructType.fromDDL("event_type STRING"))
    target = KeyedTable(f"{root}/kinds", _KINDS, ["kind"])
    drained(sinks.to_keyed_table(_kinds(rows), target, name, trigger=None))
    return target.read(spark)


@query("stream_file_limit", "SELECT 4 AS batches, count(*) AS events FROM events")
def stream_file_limit(spark, sf):
    """Four files read one a batch; a batch that runs again writes its own folder again."""
    root, name = fresh_path(spark, "limited"), f"limited_{uuid.uuid4().hex}"
    events = table(spark, sf, "events").select("event_id")
    events.repartition(4, "event_id").write.parquet(f"{root}/in")
    rows = stream_files(spark, root, "in", "parquet", StructType.fromDDL("event_id BIGINT"), max_files=1)
    drained(sinks.each_batch(rows, lambda batch, n: batch.agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(
        f"{root}/out/batch={n}"), name, "append", None))
    return spark.read.parquet(f"{root}/out").agg(
        F.count_distinct("batch").cast("int").alias("batches"), F.sum("n").alias("events"))


@query("stream_progress", "SELECT true AS started, true AS ended, count(*) AS input_rows FROM events")
def stream_progress(spark, sf):
    """The records of a stream's listener: it starts, counts its input and ends."""
    records, target = [], KeyedTable(fresh_path(spark, "kinds"), _KINDS, ["kind"])
    listener = watch(spark, lambda text: records.append(json.loads(text)))
    try:
        stream = sinks.to_keyed_table(_kinds(event_stream(spark, sf)), target, f"watched_{uuid.uuid4().hex}", trigger=None)
        drained(stream)
        own = [r for r in _told(records, str(stream.id)) if r.get("id", r.get("progress", {}).get("id")) == str(stream.id)]
    finally:
        spark.streams.removeListener(listener)
    seen = {r["event"] for r in own}
    counts = [r["progress"]["numInputRows"] for r in own if r["event"] == "progress"]
    return literal_rows(spark, {"input_rows": counts}).agg(
        F.lit("started" in seen).alias("started"), F.lit("terminated" in seen).alias("ended"), F.sum("input_rows").alias("input_rows"))


def _told(records, stream_id, tries=300):
    """The records once the stream's end is among them; the listener hears of it a little later."""
    for _ in range(tries):
        if any(r["event"] == "terminated" and r["id"] == stream_id for r in records):
            break
        time.sleep(0.1)
    return list(records)


@query("stream_triggered", "SELECT event_type AS kind, count(*) AS events FROM events GROUP BY 1")
def stream_triggered(spark, sf):
    """A stream that looks for new files every second, until the waiting is over and it is stopped."""
    target = KeyedTable(fresh_path(spark, "kinds"), _KINDS, ["kind"])
    stream = sinks.to_keyed_table(_kinds(event_stream(spark, sf)), target, f"timed_{uuid.uuid4().hex}", trigger="1 second")
    stream.processAllAvailable()
    sinks.await_all(spark, 0.1)
    assert not stream.isActive
    return target.read(spark)
