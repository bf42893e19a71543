"""Time, id, histogram and text expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import histograms, ids, sql_names, times
from .registry import query, table


@query("time_formats", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M') AS minute,
  strftime(date_trunc('day', ts) + INTERVAL 1 DAY - INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') AS day_end,
  strftime(date_trunc('day', ts), '%Y-%m-%d') AS daily,
  strftime(ts::DATE - dayofweek(ts)::INT, '%Y-%m-%d') AS weekly,
  strftime(date_trunc('month', ts), '%Y-%m-%d') AS monthly, 'weekly' AS tag,
  strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%SZ') AS stamp
FROM events""")
def time_formats(spark, sf):
    starts = [times.iso_day(times.period_start("ts", p)).alias(p) for p in times.WATERMARK_DELAY]
    return table(spark, sf, "events").select(
        "event_id", times.iso_day("ts").alias("day"), times.iso_minute("ts").alias("minute"),
        F.date_format(times.end_of_day("ts"), "yyyy-MM-dd HH:mm:ss").alias("day_end"), *starts,
        times.period_tag("weekly").alias("tag"), times.day_stamp(times.iso_day("ts")).alias("stamp"))


@query("time_parsing", """
SELECT event_id,
  strftime(CASE event_id % 10 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('millisecond', ts)
    WHEN 2 THEN date_trunc('day', ts) WHEN 4 THEN date_trunc('second', ts) + INTERVAL 500 MILLISECOND
    WHEN 5 THEN date_trunc('second', ts) + INTERVAL 120 MILLISECOND WHEN 6 THEN date_trunc('second', ts) + INTERVAL 123 MILLISECOND
    WHEN 7 THEN date_trunc('second', ts) - INTERVAL 2 HOUR WHEN 8 THEN date_trunc('second', ts)
    WHEN 9 THEN date_trunc('day', ts) END, '%Y-%m-%d %H:%M:%S.%g') AS parsed,
  CASE event_id % 10 WHEN 3 THEN NULL WHEN 7 THEN strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%d') END AS day,
  CASE WHEN event_id % 10 <> 3 THEN strftime(ts, '%Y-%m-%d') ELSE '' END AS leading,
  strftime(date_trunc('day', ts), '%Y-%m-%d') AS unix_day
FROM events""")
def time_parsing(spark, sf):
    patterns = [F.date_format("ts", p) for p in (*times.STAMP_PATTERNS, times.DAY)]
    second = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    texts = [*patterns, F.lit("none"), F.concat(second, F.lit(".5Z")), F.concat(second, F.lit(".12")), F.concat(second, F.lit(".123456Z")),
             F.concat(second, F.lit("+02:00")), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.concat(patterns[2], F.lit("Tgarbage"))]
    text = F.element_at(F.array(*texts), (F.col("event_id") % 10 + 1).cast("int"))
    return table(spark, sf, "events").withColumn("text", text).select(
        "event_id", F.date_format(times.parse_stamp("text"), "yyyy-MM-dd HH:mm:ss.SSS").alias("parsed"),
        times.text_day("text").alias("day"), times.leading_day("text").alias("leading"),
        times.unix_day(F.unix_timestamp("ts")).alias("unix_day"))


@query("date_series", """
SELECT strftime(d::DATE, '%Y-%m-%d') AS day, kind, count(*) AS orders FROM (
  SELECT 'weekly' AS kind, unnest(generate_series(o_orderdate::DATE - dayofweek(o_orderdate)::INT,
    o_orderdate::DATE - dayofweek(o_orderdate)::INT + 6, INTERVAL 1 DAY)) AS d FROM orders
  UNION ALL
  SELECT 'range', unnest(generate_series(o_orderdate::DATE, o_orderdate::DATE + 2, INTERVAL 1 DAY))
  FROM orders) GROUP BY 1, 2""")
def date_series(spark, sf):
    orders = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"))
    series = F.array(
        F.struct(F.lit("weekly").alias("kind"), times.days_of_period("d", "weekly").alias("days")),
        F.struct(F.lit("range").alias("kind"), times.days_between("d", F.date_add("d", 2)).alias("days")))
    days = orders.select(F.inline(series)).select("kind", F.explode("days").alias("day"))
    counts = days.groupBy("kind", "day").agg(F.count(F.lit(1)).alias("orders"))
    return counts.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("month_days", """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m') AS month, count(*) AS orders,
  max(day(last_day(o_orderdate)))::INT AS days
FROM orders GROUP BY ALL""")
def month_days(spark, sf):
    day = F.to_date("o_orderdate")
    rows = table(spark, sf, "orders").select(
        F.date_format(times.period_start_day(day, "monthly"), "yyyy-MM").alias("month"),
        F.size(times.days_of_period(day, "monthly")).alias("n"))
    return rows.groupBy("month").agg(F.count(F.lit(1)).alias("orders"), F.max("n").alias("days"))


@query("business_days", """
SELECT o_orderkey, NOT (dayofweek(o_orderdate) IN (0, 6)
  OR strftime(o_orderdate, '%m-%d') IN ('01-01', '07-04', '12-24', '12-25')
  OR (month(o_orderdate) = 9 AND dayofweek(o_orderdate) = 1 AND day(o_orderdate) <= 7)
  OR (month(o_orderdate) = 11 AND dayofweek(o_orderdate) IN (4, 5) AND day(o_orderdate) BETWEEN 22 AND 28)
  OR (month(o_orderdate) = 5 AND dayofweek(o_orderdate) = 1 AND day(o_orderdate) > 24)) AS business
FROM orders""")
def business_days(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", times.is_business_day("o_orderdate").alias("business"))


@query("uuid_v3", """
SELECT c_custkey, substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-3' || substr(m, 14, 3) || '-'
  || CASE WHEN substr(m, 17, 1) IN ('0', '4', '8', 'c') THEN '8' WHEN substr(m, 17, 1) IN ('1', '5', '9', 'd') THEN '9'
     WHEN substr(m, 17, 1) IN ('2', '6', 'a', 'e') THEN 'a' ELSE 'b' END
  || substr(m, 18, 3) || '-' || substr(m, 21, 12) AS id
FROM (SELECT c_custkey, md5(c_name) AS m FROM customer)""")
def uuid_v3(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", ids.name_uuid("c_name").alias("id"))


@query("random_ids", """
SELECT count(*) AS rows, count(*) AS ids, 36 AS width FROM customer""")
def random_ids(spark, sf):
    rows = table(spark, sf, "customer").select(ids.random_uuid().alias("id"))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"),
                    F.max(F.length("id")).alias("width"))


@query("source_file", """
SELECT 'customer.parquet' AS file, 'part-' || (c_custkey % 3) || '.json' AS named, count(*) AS rows
FROM customer GROUP BY ALL""")
def source_file(spark, sf):
    rows = spark.read.parquet(f"{sf}/customer.parquet")
    path = F.concat(F.lit("/data/x/part-"), F.col("c_custkey") % 3, F.lit(".json"))
    # On a cluster the table is a folder: name the table, not its part files.
    file = F.when(F.input_file_name().contains("customer.parquet"), "customer.parquet").otherwise(ids.file_name())
    return rows.select(file.alias("file"), ids.file_name(path).alias("named")).groupBy("file", "named").agg(
        F.count(F.lit(1)).alias("rows"))


@query("hist_avg", """
SELECT l_orderkey, l_linenumber, round(CASE WHEN l_linenumber = 1 THEN 0 ELSE
  ((l_linenumber - 1) * (CAST(l_quantity AS BIGINT) + 1) + 2 * (l_linenumber - 1) * 11)::DOUBLE
  / (3 * (l_linenumber - 1)) END, 6) AS hist_avg
FROM lineitem""")
def hist_avg(spark, sf):
    weight = (F.col("l_linenumber") - 1).cast("bigint")
    bins = F.array(
        F.struct(weight.alias("duration"), F.col("l_quantity").cast("bigint").alias("min")),
        F.struct((weight * 2).alias("duration"), F.lit(10).cast("bigint").alias("min")))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(histograms.average_of_minima(bins), 6).alias("hist_avg"))


@query("text_functions", """
SELECT c_custkey, c_name || '_' || c_mktsegment AS joined, string_split(c_name, '#')[2] AS number,
  substr(c_name, 1, 5) AS head, replace(c_name, '#', '-') AS dashed, round(c_acctbal, 1) AS rounded,
  trunc(c_acctbal / nullif(c_nationkey, 0) * 100)::INT AS pct
FROM customer""")
def text_functions(spark, sf):
    name = F.col("c_name")
    return table(spark, sf, "customer").select(
        "c_custkey", F.concat_ws("_", name, "c_mktsegment").alias("joined"), F.split(name, "#")[1].alias("number"),
        F.substring(name, 0, 5).alias("head"), F.regexp_replace(name, "#", "-").alias("dashed"),
        F.round("c_acctbal", 1).alias("rounded"), ids.percent("c_acctbal", "c_nationkey").alias("pct"))


@query("sql_functions", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M') AS minute,
  strftime(ts::DATE - dayofweek(ts)::INT, '%Y-%m-%d') AS week, 'weekly' AS tag,
  dayofweek(ts) NOT IN (0, 6) AND strftime(ts, '%m-%d') <> '01-01' AS business,
  CASE event_type WHEN 'click' THEN 'WEB' ELSE 'OTHER' END AS category
FROM events""")
def sql_functions(spark, sf):
    from ..operators.lookups import mapping_table

    sql_names.register(spark)
    sql_names.register_period(spark, "weekly")
    sql_names.register_mapping(spark, "uaCategory", mapping_table(spark, {"click": "WEB"}))
    return spark.sql(
        "SELECT event_id, convertTime(ts) AS day, convertTimeToMinutePrecision(ts) AS minute, "
        "convertTime(aggregateStartDate(ts)) AS week, periodTag(event_type) AS tag, "
        "isBusinessDay(convertTime(ts)) AS business, uaCategory(event_type) AS category FROM {events}",
        events=table(spark, sf, "events"))
