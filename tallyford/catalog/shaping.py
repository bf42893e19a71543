"""JSON and envelope shaping, filters and routing, lookups, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lookups, sets, shaping
from ..reports import regions
from ..sources import kafka, remote, tables
from .registry import query, table


@query("json_parse", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, props AS raw FROM events""")
def json_parse(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.col("props").alias("value"))
    schema = shaping.schema_of_sample(spark, '{"k": 1}')
    parsed = F.from_json("value", schema).alias("data")
    return events.select("event_id", parsed, F.col("value").alias("raw")).select("event_id", "data.*", "raw")


@query("json_retype", """
SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, CAST(NULL AS BIGINT) AS missing, props AS raw FROM events""")
def json_retype(spark, sf):
    events = table(spark, sf, "events").withColumnRenamed("props", "raw")
    from pyspark.sql.types import StructType

    return shaping.retype(events, StructType.fromDDL("event_id BIGINT, user_id STRING, missing BIGINT"))


@query("json_round_trip", """
SELECT event_id, user_id, event_type, value FROM events""")
def json_round_trip(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return shaping.parse_value(shaping.to_json_rows(events, "value"), events.schema).drop("raw")


@query("json_message", """
SELECT event_id, 'crs' AS component, user_id AS volume,
  '{"pipeLine":"Spark","data":{"type":"' || event_type || '","volume":' || user_id || '}}' AS metrics FROM events""")
def json_message(spark, sf):
    data = F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("volume"))
    metrics = F.struct(F.lit("Spark").alias("pipeLine"), data.alias("data"))
    return table(spark, sf, "events").select("event_id", F.lit("crs").alias("component"), metrics.alias("m")).select(
        "event_id", "component", F.col("m.data.volume").alias("volume"), F.to_json("m").alias("metrics"))


@query("message_envelope", """
SELECT event_type AS key, props AS value FROM events""")
def message_envelope(spark, sf):
    rows = shaping.envelope(table(spark, sf, "events"), key="event_type", value="props")
    return kafka.messages(rows)


_LINE = """
  '{"' || CASE event_id % 3 WHEN 0 THEN 'appname' ELSE '_appname' END || '":"' || event_type || '","'
  || CASE WHEN user_id % 2 = 0 THEN 'timeRcvd' ELSE '@timestamp' END || '":"'
  || strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z","@message":"T: {\\"k\\":' || (event_id % 7) || '}"}'"""


def raw_lines(spark, sf):
    """Raw JSON lines, some with an embedded message."""
    app = F.when(F.col("event_id") % 3 == 0, "appname").otherwise("_appname")
    time = F.when(F.col("user_id") % 2 == 0, "timeRcvd").otherwise("@timestamp")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    line = F.format_string(
        '{"%s":"%s","%s":"%s","@message":"T: {\\"k\\":%d}"}', app, "event_type", time, stamp, F.col("event_id") % 7)
    return table(spark, sf, "events").select("event_id", line.alias("value"))


@query("event_time_of_line", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS at FROM events""")
def event_time_of_line(spark, sf):
    return raw_lines(spark, sf).select("event_id", shaping.received_time("value").alias("at"))


@query("unwrap_message", f"""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN line
  ELSE replace(line, ',"@message":"T: {{\\"k\\":' || (event_id % 7) || '}}"', ',"SM":{{"k":' || (event_id % 7) || '}}') END
  AS value
FROM (SELECT *, {_LINE} AS line FROM events)""")
def unwrap_message(spark, sf):
    return raw_lines(spark, sf).select("event_id", shaping.unwrap_message("value").alias("value"))


@query("tag_route", """
SELECT strftime(ts, '%Y-%m-%d') AS pdate, count(*) AS lines FROM events
WHERE event_type IN ('click', 'view') GROUP BY 1""")
def tag_route(spark, sf):
    return shaping.route(raw_lines(spark, sf), "click, view").groupBy("pdate").agg(F.count("value").alias("lines"))


@query("split_by_tag", """
SELECT event_type AS tag, strftime(ts, '%Y-%m-%d') AS pdate, count(*) AS lines FROM events
WHERE event_type IN ('click', 'view', 'error') GROUP BY 1, 2""")
def split_by_tag(spark, sf):
    return shaping.split_by_tag(raw_lines(spark, sf), ["click", "view", "error"]).groupBy("tag", "pdate").agg(
        F.count("value").alias("lines"))


@query("tag_contains", """
SELECT doc_id, lang FROM documents WHERE contains(text, 'the') OR contains(text, 'ou')""")
def tag_contains(spark, sf):
    text = F.col("text")
    return table(spark, sf, "documents").where(text.contains("the") | text.contains("ou")).select("doc_id", "lang")


@query("conditional_filters", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 25 AND l_returnflag = 'A' THEN 1 ELSE 0 END AS big,
  CASE WHEN l_discount > 0.05 THEN l_returnflag END AS flag, coalesce(nullif(l_linestatus, 'F'), 'unknown') AS status
FROM lineitem
WHERE (l_returnflag = 'A' OR (l_returnflag = 'N' AND l_tax <= 0.04)) AND l_linestatus <> 'X'
  AND l_shipdate > DATE '1996-01-01' AND l_shipdate < DATE '1997-01-01'""")
def conditional_filters(spark, sf):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return spark.read.parquet(f"{sf}/lineitem.parquet").where(
        ((flag == "A") | ((flag == "N") & (F.col("l_tax") <= 0.04))) & (status != "X")
        & (F.col("l_shipdate") > F.lit("1996-01-01").cast("timestamp_ntz"))
        & (F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    ).select(
        "l_orderkey", "l_linenumber",
        F.when((F.col("l_quantity") > 25) & (flag == "A"), 1).otherwise(0).alias("big"),
        F.when(F.col("l_discount") > 0.05, flag).alias("flag"),
        F.coalesce(F.nullif(status, F.lit("F")), F.lit("unknown")).alias("status"))


@query("list_filters", """
SELECT p_partkey, lower(p_type) AS kind FROM part
WHERE p_type IN ('PROMO', 'SMALL') AND p_name LIKE '%red%'""")
def list_filters(spark, sf):
    rows = table(spark, sf, "part").where(F.col("p_type").isin("PROMO", "SMALL") & F.col("p_name").like("%red%"))
    return rows.select("p_partkey", F.lower("p_type").alias("kind"))


@query("table_rows", """
SELECT c_custkey, replace(c_name, '#', '''''') AS c_name, c_acctbal FROM customer WHERE c_nationkey <> 3
UNION ALL SELECT c_custkey, NULL, NULL FROM customer WHERE c_nationkey = 3 AND c_custkey % 2 = 0""")
def table_rows(spark, sf):
    listed = F.col("c_nationkey") != 3
    rows = table(spark, sf, "customer").select(
        F.when(listed | (F.col("c_custkey") % 2 == 0), F.col("c_custkey")).alias("C_CUSTKEY"),
        F.when(listed, F.regexp_replace("c_name", "#", "'")).alias("C_Name"),
        F.when(listed, F.col("c_acctbal")).alias("c_acctbal"), F.lit("x").alias("raw"))
    return shaping.escape_quotes(shaping.table_rows(rows))


@query("explode_prefix", """
SELECT string_split(w, '-')[1] AS word, count(*) AS parts
FROM (SELECT unnest(string_split(p_name, ' ')) || '-' || p_size AS w FROM part) GROUP BY 1""")
def explode_prefix(spark, sf):
    words = table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("w"), "p_size")
    prefix = F.split(F.concat("w", F.lit("-"), "p_size"), "-")[0].alias("word")
    return words.select(prefix).groupBy("word").agg(F.count(F.lit(1)).alias("parts"))


@query("mapping_lookup", """
SELECT l_orderkey, l_linenumber, CASE l_returnflag || '|' || l_linestatus WHEN 'A|F' THEN 'Desktop' WHEN 'N|O' THEN 'Web'
  ELSE 'Other' END AS ep1, CASE l_returnflag WHEN 'A' THEN 'DESKTOP' ELSE 'OTHER' END AS category,
  CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS listed
FROM lineitem""")
def mapping_lookup(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    rows = lookups.endpoint_class(
        rows, lookups.mapping_table(spark, {"A|F": "Desktop", "N|O": "Web"}), "l_returnflag", "l_linestatus")
    rows = lookups.agent_category(rows, lookups.mapping_table(spark, {"A": "DESKTOP"}), "l_returnflag", "category")
    rows = lookups.flag_members(rows, lookups.member_list(spark, ["R"], "f"), "l_returnflag", "listed", "1", "0")
    return rows.select("l_orderkey", "l_linenumber", "ep1", "category", "listed")


@query("member_filters", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O')
  AND o_orderpriority NOT IN ('5-LOW')""")
def member_filters(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    rows = lookups.keep_members(rows, lookups.member_list(spark, ["F", "O"], "s"), "o_orderstatus")
    rows = lookups.drop_members(rows, lookups.member_list(spark, ["5-LOW"], "p"), "o_orderpriority")
    return rows.select("o_orderkey", "o_orderstatus")


@query("missing_groups", """
SELECT c.c_custkey, coalesce(n, 0) AS orders FROM customer c LEFT JOIN (
  SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) o ON c.c_custkey = o.o_custkey""")
def missing_groups(spark, sf):
    counts = table(spark, sf, "orders").where(F.col("o_orderstatus") == "P").groupBy(
        F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders"))
    return lookups.with_every_group(table(spark, sf, "customer").select("c_custkey"), counts, ["c_custkey"], ["orders"])


@query("two_key_join", """
SELECT l.l_partkey, l.l_suppkey, l.n, a.avg_qty FROM (
  SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) l
JOIN (SELECT l_partkey, l_suppkey, trunc(avg(l_quantity))::INT AS avg_qty FROM lineitem WHERE l_returnflag <> 'R'
  GROUP BY ALL) a ON l.l_partkey = a.l_partkey AND l.l_suppkey = a.l_suppkey""")
def two_key_join(spark, sf):
    lines = table(spark, sf, "lineitem")
    keys = ["l_partkey", "l_suppkey"]
    current = lines.where(F.col("l_returnflag") == "R").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    average = lines.where(F.col("l_returnflag") != "R").groupBy(*keys).agg(F.avg("l_quantity").cast("int").alias("avg_qty"))
    return current.join(average, keys)


def org_regions(spark, sf):
    """Nations with a region name; nations of region 4 are unknown."""
    nation = table(spark, sf, "nation").where(F.col("n_regionkey") != 4)
    names = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return nation.join(names, "n_regionkey").select(F.col("n_nationkey").alias("orgId"), F.col("r_name").alias("region"))


def customers_by_org(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("orgId"))


@query("region_semi", """
SELECT c_custkey, c_nationkey AS orgId FROM customer WHERE c_nationkey IN (
  SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE' AND n_regionkey <> 4)
""")
def region_semi(spark, sf):
    return regions.in_region(customers_by_org(spark, sf), org_regions(spark, sf), "EUROPE").select("c_custkey", "orgId")


@query("region_anti", """
SELECT c_custkey, c_nationkey AS orgId FROM customer WHERE c_nationkey NOT IN (
  SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE' AND n_regionkey <> 4)
""")
def region_anti(spark, sf):
    rows = regions.outside_region(customers_by_org(spark, sf), org_regions(spark, sf), "EUROPE")
    return rows.select("c_custkey", "orgId")


@query("missing_region", """
SELECT c_nationkey AS orgId FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 4)
""")
def missing_region(spark, sf):
    return regions.without_region(customers_by_org(spark, sf), org_regions(spark, sf))


@query("balanced_union", """
SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def balanced_union(spark, sf):
    customers = table(spark, sf, "customer").selectExpr("c_custkey AS key", "c_name AS name", "c_mktsegment AS segment")
    suppliers = table(spark, sf, "supplier").selectExpr("s_name AS name", "s_suppkey AS key", "s_acctbal AS balance")
    return sets.balanced_union([customers, suppliers])


@query("union_all", """
SELECT n_nationkey AS key FROM nation UNION ALL SELECT c_nationkey FROM customer""")
def union_all(spark, sf):
    return sets.positional_union([
        table(spark, sf, "nation").selectExpr("n_nationkey AS key"), table(spark, sf, "customer").select("c_nationkey")])


@query("set_difference", """
SELECT o_custkey AS key FROM orders EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'""")
def set_difference(spark, sf):
    orders = table(spark, sf, "orders")
    rest = orders.where(F.col("o_orderstatus") == "F").selectExpr("o_custkey AS key")
    return sets.difference(orders.selectExpr("o_custkey AS key"), rest)


@query("bag_difference", """
SELECT o_custkey AS key FROM orders EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'""")
def bag_difference(spark, sf):
    orders = table(spark, sf, "orders")
    rest = orders.where(F.col("o_orderstatus") == "F").selectExpr("o_custkey AS key")
    return sets.difference(orders.selectExpr("o_custkey AS key"), rest, keep_duplicates=True)


@query("complement", """
SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR quality <> 1""")
def complement(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return sets.complement(rows, F.col("quality") == 1).select("doc_id", "quality")


@query("measures_to_rows", """
SELECT l_orderkey, l_linenumber, 'quantity' AS measure, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'price', l_extendedprice FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'tax', l_tax FROM lineitem""")
def measures_to_rows(spark, sf):
    measures = {"quantity": F.col("l_quantity"), "price": F.col("l_extendedprice"), "tax": F.col("l_tax")}
    return sets.measures_to_rows(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], measures)


@query("keyed_read", """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE strftime(l_shipdate, '%Y-%m-%d') = '1997-03-05'
  AND l_returnflag IN ('A', 'N')
UNION ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE strftime(l_shipdate, '%Y-%m-%d') = '1997-03-06'
  AND l_returnflag = 'R'""")
def keyed_read(spark, sf):
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    facts = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", day.alias("pdate"), F.col("l_returnflag").alias("relation_name"))
    first = tables.select_rows(facts, "1997-03-05", "A, N", time_column="l_shipdate")
    second = tables.in_days(facts, "l_shipdate", "1997-03-06", "1997-03-07").where(tables.any_key("1997-03-06", "R"))
    return first.unionAll(second).select("l_orderkey", "l_linenumber")


@query("month_read", """
SELECT strftime(l_shipdate, '%Y-%m-%d') AS pdate, count(*) AS rows FROM lineitem
WHERE strftime(l_shipdate, '%Y-%m') = '1997-03' GROUP BY 1""")
def month_read(spark, sf):
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    facts = table(spark, sf, "lineitem").select("l_shipdate", day.alias("pdate"), F.substring(day, 1, 7).alias("month"))
    return tables.select_rows(facts, month="1997-03", time_column="l_shipdate").groupBy("pdate").agg(F.count(F.lit(1)).alias("rows"))


@query("row_count", "SELECT count(*) AS rows FROM lineitem")
def row_count(spark, sf):
    return tables.row_count(table(spark, sf, "lineitem"))


def _price_call(body: str) -> str:
    """Stands in for a service: answers rows with a price each."""
    import json

    return json.dumps([{"p_partkey": r["p_partkey"], "price": r["p_size"] * 100} for r in json.loads(body)])


@query("remote_enrichment", "SELECT p_partkey, CAST(p_size AS BIGINT) * 100 AS price FROM part")
def remote_enrichment(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_size")
    return remote.enrich_in_batches(parts, _price_call, "p_partkey BIGINT, price BIGINT", 500)
