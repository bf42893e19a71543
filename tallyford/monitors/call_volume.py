"""Call volume model and alerts per organisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import percent
from ..functions.times import add_days, business_day
from ..operators.lookups import with_every_group
from ..operators.ranking import top_n
from . import common

# Defaults of the monitor.
TOP_ORGS = 50
THRESHOLD = 0.33
HISTORY_DAYS = 30


def on_days(calls: DataFrame, days: list[str]) -> DataFrame:
    """Records that start on one of the days, given in order.

    The text range is what a source can use to skip data; the list of dates is exact.
    """
    if not days:
        return calls.limit(0)
    start = F.col("locus_start_time")
    spanned = calls.where((start >= days[0]) & (start < add_days(days[-1], 1)))
    return spanned.where(F.substring(start, 1, 10).isin(days))


def average_per_org(calls: DataFrame, days: list[str]) -> DataFrame:
    """Mean number of records per organisation over those of the days that have any.

    Records whose start time does not begin with one of the dates do not count.
    """
    rows = on_days(calls, days).select("org_id", F.substring("locus_start_time", 1, 10).alias("pdate"))
    per_day = rows.groupBy("org_id", "pdate").agg(F.count(F.lit(1)).alias("records"))
    return per_day.groupBy("org_id").agg(F.avg("records").alias("avg"))


def model(calls: DataFrame, end: str, days: int = HISTORY_DAYS, orgs: int = TOP_ORGS) -> DataFrame:
    """Average records per business day of the organisations with the most, to be stored."""
    return top_n(average_per_org(calls, common.business_days_before(end, days + 1)), orgs, "avg", "org_id")


def alerts(
    calls: DataFrame, averages: DataFrame, day: str, threshold: float = THRESHOLD, event_time: str = "",
    orgs: int = TOP_ORGS,
) -> DataFrame:
    """The day's volume of the model's organisations against the model, a stored table.

    Organisations without records count as 0. Without any record at all there is a single row for
    all organisations. Days off give no rows.
    """
    known = averages.select("org_id", F.col("avg").alias("historyAvg"))
    ours = on_days(calls, [day]).join(known.select("org_id"), "org_id", "left_semi")
    current = average_per_org(ours, [day]).withColumnRenamed("avg", "currentAvg")
    ratio = F.try_divide(F.col("currentAvg"), F.col("historyAvg"))
    off = F.col("currentAvg").isNull() | (ratio < threshold) | (ratio > 2 / threshold)
    context = [
        F.lit(event_time).alias("eventTimestamp"), F.lit(day).alias("eventTime"),
        F.lit(str(threshold)).alias("threshold")]
    rows = with_every_group(known, current, ["org_id"], ["currentAvg"]).where(F.lit(business_day(day))).select(
        "org_id", "currentAvg", "historyAvg", percent("currentAvg", "historyAvg").alias("percentage"), *context,
        F.when(off, "true").otherwise("false").alias("status"))
    silent = known.agg(F.sum("historyAvg").alias("historyAvg")).select(
        F.lit(f"All Top {orgs} Orgs Have No Data").alias("org_id"), F.lit(0.0).alias("currentAvg"), "historyAvg",
        F.lit(0).alias("percentage"), *context, F.lit("true").alias("status"))
    # Whether any record exists needs one row of the day, not the day's counts.
    return rows.where(ours.exists()).unionByName(silent.where(~ours.exists() & F.col("historyAvg").isNotNull()))


def messages(rows: DataFrame) -> DataFrame:
    value = F.struct(
        F.col("currentAvg").alias("volume"), F.col("historyAvg").alias("historicalAverageVolume"), "percentage",
        "threshold")
    metrics = F.struct(
        F.col("eventTime").alias("time"), F.lit("orgID").alias("name"), F.col("org_id").alias("id"),
        value.alias("value"), F.col("status").alias("isAlert"))
    fixed = {"component": "CRS", "product": "Teams", "service": "Reporting", "type": "CallAnalyzer"}
    return rows.select(
        *[F.lit(text).alias(name) for name, text in fixed.items()], F.col("eventTimestamp").alias("eventTime"),
        F.lit("processing").alias("stage"), metrics.alias("metrics"))
