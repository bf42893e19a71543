"""Period aggregates, deduplication, ranking and keyed rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import keyed, lookups, periods, ranking
from ..operators.shaping import normalize_time
from ..plans.sql_stage import sql_stage
from .registry import query, table, with_text_time


_START = {
    "daily": "date_trunc('day', ts)",
    "weekly": "CAST(ts::DATE - dayofweek(ts)::INT AS TIMESTAMP)",
    "monthly": "date_trunc('month', ts)",
}
_ACTIVE = """
SELECT t || '^' || event_type || '^activeUser^{period}' AS "eventKey", t AS time_stamp, event_type AS "orgId",
  count(DISTINCT user_id) AS "userCountByOrg", '{period}' AS period, 'activeUser' AS relation_name
FROM (SELECT strftime({start}, '%Y-%m-%d %H:%M:%S') AS t, event_type, user_id FROM events) GROUP BY t, event_type"""


def event_facts(spark, sf):
    return table(spark, sf, "events").select(
        F.col("ts").alias("time_stamp"), F.col("event_type").alias("orgId"), F.col("user_id").alias("userId"), "value",
        "event_id")


def active_users(spark, sf, period):
    counts = periods.distinct_count(
        event_facts(spark, sf), period, ["orgId"], "userId", "userCountByOrg", "activeUser")
    return with_text_time(counts)


for _period in _START:
    query(f"period_active_users_{_period}", _ACTIVE.format(period=_period, start=_START[_period]))(
        lambda spark, sf, period=_period: active_users(spark, sf, period))


@query("user_day_rollup", """
SELECT strftime(date_trunc('day', ts) + INTERVAL 1 DAY - INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') AS time_stamp, user_id,
  sum((event_type = 'click')::INT)::BIGINT AS clicks, sum((event_type = 'purchase')::INT)::BIGINT AS purchases
FROM events GROUP BY 1, 2""")
def user_day_rollup(spark, sf):
    from ..functions.times import end_of_day

    kind = F.col("event_type")
    return table(spark, sf, "events").groupBy(
        F.date_format(end_of_day("ts"), "yyyy-MM-dd HH:mm:ss").alias("time_stamp"), "user_id").agg(
        F.sum((kind == "click").cast("int")).alias("clicks"), F.sum((kind == "purchase").cast("int")).alias("purchases"))


@query("distinct_tuples", """
SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day, user_id, event_type FROM events""")
def distinct_tuples(spark, sf):
    rows = periods.cut(table(spark, sf, "events"), "daily", ["user_id", "event_type"], "ts")
    rows = rows.dropDuplicates(["time_stamp", "user_id", "event_type"])
    return rows.select(F.date_format("time_stamp", "yyyy-MM-dd").alias("day"), "user_id", "event_type")


@query("minutes_by_lookup", """
SELECT CASE l_returnflag || '|' || l_linestatus WHEN 'A|F' THEN 'Desktop' WHEN 'N|O' THEN 'Web' ELSE 'Other' END AS ep1,
  round(sum(l_quantity) / 60)::BIGINT AS minutes FROM lineitem GROUP BY 1""")
def minutes_by_lookup(spark, sf):
    rows = lookups.endpoint_class(
        table(spark, sf, "lineitem"), lookups.mapping_table(spark, {"A|F": "Desktop", "N|O": "Web"}),
        "l_returnflag", "l_linestatus")
    return rows.groupBy("ep1").agg(F.round(F.sum("l_quantity") / 60).cast("bigint").alias("minutes"))


@query("distinct_calls", """
SELECT strftime(l_shipdate, '%Y-%m') AS month, l_returnflag AS flag, count(DISTINCT l_orderkey) AS calls
FROM lineitem WHERE nullif(l_linestatus, 'O') IS NULL OR l_linenumber <> 1 GROUP BY 1, 2""")
def distinct_calls(spark, sf):
    status = F.nullif(F.col("l_linestatus"), F.lit("O"))
    rows = table(spark, sf, "lineitem").where(status.isNull() | (F.col("l_linenumber") != 1))
    counts = periods.distinct_count(
        rows.withColumnRenamed("l_returnflag", "flag"), "monthly", ["flag"], "l_orderkey", "calls", "calls", "l_shipdate")
    return counts.select(F.date_format("time_stamp", "yyyy-MM").alias("month"), "flag", "calls")


@query("dedup_sum", """
SELECT source, count(*) AS files, sum(n_chars)::BIGINT AS bytes
FROM (SELECT DISTINCT source, n_chars FROM documents) GROUP BY 1""")
def dedup_sum(spark, sf):
    rows = table(spark, sf, "documents").select("source", "n_chars").dropDuplicates(["source", "n_chars"])
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("files"), F.sum("n_chars").alias("bytes"))


@query("group_aggregates", """
SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS rows, count(nullif(l_linenumber, 1)) AS later,
  count(DISTINCT l_suppkey) AS suppliers, sum(l_linenumber)::BIGINT AS lines, trunc(avg(l_quantity))::INT AS avg_qty
FROM lineitem GROUP BY 1, 2""")
def group_aggregates(spark, sf):
    return table(spark, sf, "lineitem").groupBy(
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.nullif(F.col("l_linenumber"), F.lit(1))).alias("later"),
        F.count_distinct("l_suppkey").alias("suppliers"), F.sum("l_linenumber").alias("lines"),
        F.avg("l_quantity").cast("int").alias("avg_qty"))


@query("two_level_average", """
SELECT event_type, round(avg(n), 6) AS avg_per_day FROM (
  SELECT event_type, ts::DATE AS d, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1""")
def two_level_average(spark, sf):
    per_day = table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("d")).agg(
        F.count(F.lit(1)).alias("n"))
    return per_day.groupBy("event_type").agg(F.round(F.avg("n"), 6).alias("avg_per_day"))


@query("global_sum", "SELECT sum(l_linenumber)::BIGINT AS total, round(sum(l_quantity), 2) AS quantity FROM lineitem")
def global_sum(spark, sf):
    return table(spark, sf, "lineitem").agg(
        F.sum("l_linenumber").alias("total"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("tumbling_windows", """
SELECT strftime(ts::DATE - dayofweek(ts)::INT, '%Y-%m-%d') AS week, event_type, count(*) AS events
FROM events GROUP BY 1, 2""")
def tumbling_windows(spark, sf):
    rows = periods.tumbling(table(spark, sf, "events"), "ts", "weekly", ["event_type"], F.count(F.lit(1)).alias("events"))
    return rows.select(F.date_format("time_stamp", "yyyy-MM-dd").alias("week"), "event_type", "events")


def _orders_per_customer(spark, sf):
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum((F.col("o_orderstatus") == "F").cast("int")).alias("finished"))
    return orders.join(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_custkey")


_PER_CUSTOMER = """
WITH c AS (SELECT o_custkey AS c_custkey, c_mktsegment, count(*) AS orders,
    sum((o_orderstatus = 'F')::INT)::BIGINT AS finished
  FROM orders JOIN customer ON o_custkey = customer.c_custkey GROUP BY 1, 2)"""


@query("topk_dense_rank", f"""{_PER_CUSTOMER}
SELECT c_mktsegment, c_custkey, orders FROM (
  SELECT *, dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY orders DESC) AS r FROM c) WHERE r <= 5""")
def topk_dense_rank(spark, sf):
    rows = ranking.top_ranked(_orders_per_customer(spark, sf), ["c_mktsegment"], F.col("orders"), 5)
    return rows.select("c_mktsegment", "c_custkey", "orders")


@query("topk_nonzero", f"""{_PER_CUSTOMER}
SELECT c_mktsegment, c_custkey, finished FROM (
  SELECT *, dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY finished DESC) AS r FROM c WHERE finished > 0)
WHERE r <= 3""")
def topk_nonzero(spark, sf):
    rows = _orders_per_customer(spark, sf).where(F.col("finished") > 0)
    return ranking.top_ranked(rows, ["c_mktsegment"], F.col("finished"), 3).select("c_mktsegment", "c_custkey", "finished")


@query("topn_global", """
SELECT l_suppkey, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def topn_global(spark, sf):
    rows = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.round(F.sum("l_quantity"), 2).alias("quantity"))
    return ranking.top_n(rows, 10, "quantity", "l_suppkey")


@query("quality_flags", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity <= 30 AND l_discount <= 0.05 AND l_tax <= 0.05 THEN 1 ELSE 0 END
  AS good FROM lineitem""")
def quality_flags(spark, sf):
    good = (F.col("l_quantity") <= 30) & (F.col("l_discount") <= 0.05) & (F.col("l_tax") <= 0.05)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(good, 1).otherwise(0).alias("good"))


@query("bad_total_merge", """
SELECT coalesce(a.flag, b.flag) AS flag, bad, total FROM (
  SELECT l_returnflag AS flag, count(DISTINCT l_orderkey) AS bad FROM lineitem WHERE l_quantity > 49 AND l_returnflag <> 'R'
  GROUP BY 1) a
FULL JOIN (SELECT l_returnflag AS flag, count(DISTINCT l_orderkey) AS total FROM lineitem GROUP BY 1) b
  ON a.flag = b.flag""")
def bad_total_merge(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "flag")
    bad = lines.where((F.col("l_quantity") > 49) & (F.col("flag") != "R")).groupBy("flag").agg(
        F.count_distinct("l_orderkey").alias("bad"))
    total = lines.groupBy("flag").agg(F.count_distinct("l_orderkey").alias("total"))
    return keyed.merge_by_key(bad, total, ["flag"])


@query("last_write", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
WHERE r = 1""")
def last_write(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return keyed.last_write(orders, ["o_custkey"], F.struct("o_orderdate", "o_orderkey")).drop("o_orderdate")


@query("keyed_merge", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS status, o_totalprice AS price,
  CASE WHEN o_orderstatus = 'P' THEN o_custkey END AS closed_by FROM orders
UNION ALL SELECT -1 - o_orderkey, 'F', NULL, o_custkey FROM orders WHERE o_orderstatus = 'O'""")
def keyed_merge(spark, sf):
    orders = table(spark, sf, "orders")
    target = orders.selectExpr("o_orderkey", "o_orderstatus AS status", "o_totalprice AS price")
    closed = orders.where(F.col("o_orderstatus") == "P").selectExpr(
        "o_orderkey", "'F' AS status", "o_custkey AS closed_by")
    new = orders.where(F.col("o_orderstatus") == "O").selectExpr(
        "-1 - o_orderkey AS o_orderkey", "'F' AS status", "o_custkey AS closed_by")
    return keyed.merge_by_key(target, closed.unionAll(new), ["o_orderkey"])


@query("keyed_delete", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'F'""")
def keyed_delete(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    doomed = orders.where(F.col("o_orderstatus") == "F")
    return keyed.delete_by_key(orders, doomed, ["o_orderkey"]).drop("o_orderstatus")


@query("time_normalised", """
SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts FROM events""")
def time_normalised(spark, sf):
    text = table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"))
    return with_text_time(normalize_time(text, "ts"), "ts")


# Visitors per kind of event: how many came back for the same kind within a period does not matter.
VISITORS_SQL = """
CREATE OR REPLACE TEMPORARY VIEW visits AS
  SELECT aggregateStartDate(time_stamp) AS time_stamp, orgId AS kind, userId AS visitor, userId % 2 AS side
  FROM SOURCE_VIEW WHERE value > 1;
CREATE OR REPLACE TEMPORARY VIEW visitors AS DropDuplicates time_stamp, kind, visitor;
SELECT time_stamp, kind, periodTag(kind) AS period, count(*) AS visitors, sum(side) AS odd_visitors
FROM visitors GROUP BY time_stamp, kind
"""
VISITORS_TWIN = """
SELECT t AS time_stamp, event_type AS kind, '{period}' AS period, count(*) AS visitors,
  sum(user_id % 2)::BIGINT AS odd_visitors
FROM (SELECT DISTINCT strftime({start}, '%Y-%m-%d %H:%M:%S') AS t, event_type, user_id FROM events WHERE value > 1)
GROUP BY t, event_type"""


@query("sql_stage", VISITORS_TWIN.format(period="weekly", start=_START["weekly"]))
def staged_sql(spark, sf):
    return with_text_time(sql_stage(spark, VISITORS_SQL, event_facts(spark, sf), {"aggregatePeriod": "weekly"}))
