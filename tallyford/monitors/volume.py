"""Volume monitor: today's counts against the average of like days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import percent
from ..functions.times import iso_day
from . import common

# Relations of the organisation count, history length, floors, alerting relations.
COUNTED = ["fileUsed", "activeUser", "callDuration", "callQuality", "messageSent"]
HISTORY_DAYS = 64
ACTIVE_FLOOR, FLOOR = 800, 100
ZERO_ALERTS = ["fileUsed", "callDuration", "messageSent", "number_of_good_calls"]
ZERO_ALERT_PERIODS = ["%weekly%", "%monthly%"]
RATIO_ALERTS = ["activeUser", "number_of_total_calls"]


def dated(aggregates: DataFrame) -> DataFrame:
    return aggregates.withColumn("pdate", iso_day("time_stamp"))


def measures() -> tuple[Column, Column]:
    """The monitored measure of a row: its name, with the period where that is not daily, and its count."""
    relation = F.col("relation_name")
    cases: list[tuple[Column, str, Column]] = [
        (relation == "fileUsed", "fileUsed", F.col("files")),
        (relation == "activeUser", "activeUser", F.col("usercountbyorg")),
        ((relation == "messageSent") & (F.col("ua_category") == "DESKTOP"), "messageSent", F.col("messages")),
        ((relation == "callDuration") & (F.col("ep1") == "Desktop"), "number_of_total_calls",
         F.col("number_of_successful_calls")),
        (relation == "callQuality", "number_of_good_calls",
         F.col("number_of_total_calls") - F.col("number_of_bad_calls")),
    ]
    name, count = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    for condition, shown, measure in cases:
        name = F.when(condition, shown).otherwise(name)
        count = F.when(condition, measure.cast("bigint")).otherwise(count)
    # A missing period reads as not daily and makes the name null, as text concatenation does.
    return F.when(F.col("period") == "daily", name).otherwise(F.concat(name, F.lit("-"), F.col("period"))), count


def counts(aggregates: DataFrame, orgs: Sequence[str], org: str = "*") -> DataFrame:
    """`(of_all, orgid, relation_name, pdate, count)`: each row as a report of its organisation, and as one more organisation
    that reported its relation. One pass: a row is expanded into both."""
    ours = F.col("orgid").isin(list(orgs))
    if org != "*":
        ours = ours & (F.col("orgid") == org)
    name, count = measures()
    reported = F.struct(
        F.lit(True).alias("of_all"), F.lit("orgCount").alias("orgid"),
        F.when(F.col("period") == "daily", F.col("relation_name")).alias("relation_name"), F.lit(1).cast("bigint").alias("count"))
    measured = F.struct(
        F.lit(False).alias("of_all"), F.col("orgid").alias("orgid"), F.when(ours, name).alias("relation_name"), count.alias("count"))
    return dated(aggregates).select("pdate", F.explode(F.array(reported, measured)).alias("row")).where(
        F.col("row.relation_name").isNotNull()).select("row.of_all", "row.orgid", "row.relation_name", "pdate", "row.count")


def flagged(rows: DataFrame, day: str, threshold: float) -> DataFrame:
    """The monitored day of `counts` with the average of like days, the percentage and the status.

    Day and history come from the same sums. A relation is counted as 0 on the day when no organisation reported it.
    """
    today = F.col("pdate") == day
    past = F.col("pdate").isin(common.like_days_before(day, HISTORY_DAYS))
    # Reports of the day stay apart by their count; equal ones are one row with a number.
    value = F.when(today & ~F.col("of_all"), F.col("count"))
    sums = rows.where(today | past).groupBy("of_all", "orgid", "relation_name", "pdate", value.alias("value")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("count").alias("sum"), F.count("count").alias("known"))
    known = F.when(past, F.when(F.col("of_all"), 1).otherwise(F.col("known")))
    shown = F.when(F.col("of_all"), F.col("sum")).otherwise(F.col("value"))
    groups = sums.groupBy("of_all", "orgid", "relation_name").agg(
        F.sum(F.when(past, F.col("sum"))).alias("sum"), F.sum(known).alias("known"),
        F.collect_list(F.when(today, F.struct(
            shown.alias("count"), F.when(F.col("of_all"), 1).otherwise(F.col("rows")).cast("int").alias("times")))).alias("reports"))
    silent_day = F.col("of_all") & F.col("relation_name").isin(COUNTED) & (F.size("reports") == 0)
    zero = F.array(F.struct(F.lit(0).cast("bigint").alias("count"), F.lit(1).alias("times")))
    joined = groups.where(F.col("known") > 0).select(
        "orgid", "relation_name", F.lit(day).alias("pdate"), (F.col("sum").cast("double") / F.col("known")).alias("avg"),
        F.explode(F.when(silent_day, zero).otherwise(F.col("reports"))).alias("report")).select(
        "orgid", "relation_name", "pdate", "avg", F.explode(F.array_repeat(F.col("report.count"), F.col("report.times"))).alias("count"))
    relation, count, avg = F.col("relation_name"), F.col("count"), F.col("avg")
    ratio = F.try_divide(count, avg)
    like_period = F.lit(False)
    for pattern in ZERO_ALERT_PERIODS:
        like_period = like_period | relation.like(pattern)
    big_enough = F.when(relation == "activeUser", avg > ACTIVE_FLOOR).otherwise(avg > FLOOR)
    silent = (relation.isin(ZERO_ALERTS) | like_period) & (count == 0)
    off = relation.isin(RATIO_ALERTS) & (count.isNull() | (ratio < threshold) | (ratio > 2 / threshold))
    return joined.select(
        "orgid", "relation_name", "pdate", "count", "avg", percent(count, avg).alias("percentage"),
        F.when(big_enough & (silent | off), "failure").otherwise("success").alias("status"))


def run(aggregates: DataFrame, orgs: Sequence[str], day: str, threshold: float, org: str = "*") -> DataFrame:
    """Status per organisation and relation on the monitored day; reads that day and its history, once."""
    return flagged(counts(common.within(aggregates, "time_stamp", day, HISTORY_DAYS), orgs, org), day, threshold)


def messages(rows: DataFrame) -> DataFrame:
    data = F.struct(
        F.concat("orgid", F.lit("_"), "relation_name").alias("name"), F.col("pdate").alias("reportDate"), "orgid",
        F.col("relation_name").alias("type"), F.col("count").alias("volume"),
        F.col("avg").alias("historicalAverageVolume"), "percentage", "status")
    return rows.select(*common.message(F.struct(
        F.lit("Spark").alias("pipeLine"), F.lit("DataProcess").alias("phase"),
        common.start_of().alias("sendTime"), data.alias("data"))))
