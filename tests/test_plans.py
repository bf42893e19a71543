"""What the plans look like, and that results do not depend on how the data is spread."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyford.catalog import QUERIES
from tallyford.catalog import derive
from tallyford.catalog.registry import table
from tallyford.operators import keyed, ranking
from tallyford.reports import usage


def plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


STORED = {"table_upsert", "table_delete", "insert_overwrite", "partitioned_files", "backfill", "job_plan",
          "stream_active_users", "stream_distinct_tuples", "stream_user_rollup", "call_volume_alert", "stream_files_update",
          "stream_files_complete", "job_backfill", "job_monitor", "stream_chain"}
REMOTE = {"remote_enrichment"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORED - REMOTE))
def test_no_cross_joins_and_no_python(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text
    assert "Window" not in text or "WindowGroupLimit" in text


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(entry.queries()["conditional_filters"](spark, sf_dir))
    assert "GreaterThan(l_shipdate" in text and "LessThan(l_shipdate" in text
    assert "l_extendedprice" not in text
    events = entry.queries()["period_active_users_daily"](spark, sf_dir)
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan(events)


@pytest.mark.parametrize("name", ["volume_monitor", "volume_monitor_day_off", "volume_messages", "job_backfill"])
def test_one_scan(spark, sf_dir, name):
    tree = plan(entry.queries()[name](spark, sf_dir)).split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and "Join" not in tree


def test_counts_shuffle_partial_results(spark, sf_dir):
    """One shuffle on (period, org, user), one on (period, org) after a partial count."""
    text = plan(entry.queries()["period_active_users_daily"](spark, sf_dir))
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") == 2
    assert "partial_count(userId" in text


def test_top_ranked_reuses_the_sums(spark, sf_dir):
    """The scores are aggregated once: the floors and the ranked rows read the same shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = entry.queries()["top_users"](spark, sf_dir)
        df.collect()
        assert "ReusedExchange" in df._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_top_ranked_against_a_window(spark, threshold):
    """A hot group, ties and missing scores; with and without broadcast joins."""
    hot = spark.range(3000).select(F.lit("hot").alias("g"), (F.col("id") * 7 % 61).alias("s"), "id")
    cold = spark.range(300).select((F.col("id") % 9).cast("string").alias("g"), (F.col("id") % 4).alias("s"), "id")
    missing = spark.range(5).select(F.lit("m").alias("g"), F.when(F.col("id") > 2, F.col("id")).alias("s"), "id")
    df = hot.unionAll(cold).unionAll(missing)
    rank = F.dense_rank().over(Window.partitionBy("g").orderBy(F.desc("s")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for k in (1, 2, 3, 30, 100):
            want = df.withColumn("r", rank).where(F.col("r") <= k).drop("r")
            assert rows(ranking.top_ranked(df, ["g"], F.col("s"), k).select("g", "s", "id")) == rows(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["active_user_count", "top_users", "total_calls", "bad_calls", "file_count",
                                  "volume_monitor", "usage_anomaly", "keyed_merge", "last_write", "mapping_lookup"])
def test_partition_count_and_join_kind_do_not_matter(spark, sf_dir, name):
    want = rows(entry.queries()[name](spark, sf_dir))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(entry.queries()[name](spark, sf_dir)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_hot_join_partition_is_split(spark):
    """A lookup join too large to broadcast, where one key holds a third of all rows."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.shuffle.partitions": "64"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        facts = spark.range(90000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
        lookup = spark.range(1000).select(F.col("id").cast("string").alias("k")).union(spark.sql("SELECT 'hot'"))
        df = facts.join(lookup, "k", "left_semi").groupBy("k").agg(F.count("id").alias("n"), F.max("id"))
        assert {r.k: r.n for r in df.collect()}["hot"] == 30000
        assert "skew=true" in df._jdf.queryExecution().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_events_are_filtered_without_parsing_again(spark, sf_dir):
    whole_seconds = table(spark, sf_dir, "events").withColumn("ts", F.date_trunc("second", "ts"))
    events = derive.conversation_events(whole_seconds)
    from tallyford.operators.shaping import parse_value, to_json_rows

    parsed = parse_value(to_json_rows(events), events.schema)
    report = usage.active_users(parsed, derive.excluded(spark), derive.testers(spark), derive.agents(spark), room_device_prefix=derive.ROOM_PREFIX)
    assert report._jdf.queryExecution().optimizedPlan().toString().count("from_json(") <= 2
    assert rows(report) == rows(usage.active_users(
        events, derive.excluded(spark), derive.testers(spark), derive.agents(spark), room_device_prefix=derive.ROOM_PREFIX))


def test_last_write_combines_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    text = plan(keyed.last_write(df, ["k"], F.col("v")))
    assert "partial_max_by" in text
    assert rows(keyed.last_write(df, ["k"], F.col("v"))) == ["(0, 999)", "(1, 997)", "(2, 998)"]


@pytest.mark.parametrize("name, time, scans", [
    ("license_monitor", "ts", 1), ("usage_anomaly", "l_shipdate", 1), ("usage_normal", "l_shipdate", 1),
    ("table_monitor", "l_shipdate", 1), ("daily_sums", "l_shipdate", 1), ("call_volume_model", "ts", 1),
    ("aggregate_monitor", "l_shipdate", 1), ("volume_monitor", "l_shipdate", 1)])
def test_monitors_read_their_days_only(spark, sf_dir, name, time, scans):
    """The range of days reaches each scan, and a monitor reads its table once."""
    plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(filters) == scans
    assert all(f"GreaterThanOrEqual({time}," in line and f"LessThan({time}," in line or f"EqualTo({time}," in line for line in filters)


@pytest.mark.parametrize("name, scans", [("keyed_read", 2), ("month_read", 1)])
def test_days_reach_the_scan_as_a_range(spark, sf_dir, name, scans):
    pushed = [line for line in plan(entry.queries()[name](spark, sf_dir)).splitlines() if line.startswith("PushedFilters")]
    assert len(pushed) == scans
    assert all("GreaterThanOrEqual(l_shipdate," in line and "LessThan(l_shipdate," in line for line in pushed)
