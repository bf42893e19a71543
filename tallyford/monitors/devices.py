"""Device usage monitor: per-device usage of a day against the average of the past month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import percent
from ..operators.sets import complement
from . import common

# History length; measure and its source column.
HISTORY_DAYS = 30
MEASURES = {
    "incall": "incall",
    "cable": "local_share_cable",
    "wireless": "local_share_wireless",
    "whiteboard": "white_boarding",
}


def run(usage: DataFrame, orgs: Sequence[str], day: str) -> DataFrame:
    """Per-device usage of the day, averages of the history and the difference in percent.

    One pass: usage per organisation and day, then day and history side by side. Organisations
    without both do not appear.
    """
    past = F.col("pdate").isin(common.days_before(day, HISTORY_DAYS))
    today = F.col("pdate") == day
    rows = common.of_orgs(usage, orgs).where(past | today)
    per_day = rows.groupBy("orgid", "pdate").agg(
        *[F.sum(column).alias(name) for name, column in MEASURES.items()],
        F.count_distinct("deviceid").alias("deviceCount"))
    per_device = per_day.select(
        "orgid", "pdate", "deviceCount",
        *[F.try_divide(F.col(name), F.col("deviceCount")).alias(name) for name in MEASURES])
    per_org = per_device.groupBy("orgid").agg(
        F.max(F.when(today, F.lit(day))).alias("pdate"),
        F.max(F.when(past, F.lit(True))).alias("_past"),
        F.max(F.when(today, F.col("deviceCount"))).alias("deviceCount"),
        *[F.max(F.when(today, F.col(name))).alias(name) for name in MEASURES],
        *[F.avg(F.when(past, F.col(name))).cast("int").alias(f"{name}Avg") for name in MEASURES])
    both = per_org.where(F.col("pdate").isNotNull() & F.col("_past")).drop("_past")
    return both.select("*", *[
        percent(F.col(name) - F.col(f"{name}Avg"), F.col(f"{name}Avg")).alias(f"{name}DiffPctg")
        for name in MEASURES])


def is_normal(threshold: float) -> Column:
    """All measures within the threshold of their average; null when a measure is missing."""
    normal = F.lit(True)
    for name in MEASURES:
        avg = F.col(f"{name}Avg")
        normal = normal & (F.col(name) >= avg * (1 - threshold)) & (F.col(name) <= avg * (1 + threshold))
    return normal


def normal_rows(rows: DataFrame, threshold: float) -> DataFrame:
    return rows.where(is_normal(threshold))


def anomalies(rows: DataFrame, threshold: float) -> DataFrame:
    """All rows that are not normal; a missing measure is an anomaly."""
    return complement(rows, is_normal(threshold))


def messages(rows: DataFrame, alert: bool) -> DataFrame:
    data = F.struct(
        "orgid", *MEASURES, *[f"{n}Avg" for n in MEASURES], *[f"{n}DiffPctg" for n in MEASURES], "deviceCount",
        F.lit(str(alert).lower()).alias("isAlert"), F.col("pdate").alias("reportDate"))
    return rows.select(*common.message(F.struct(
        F.lit("RoomDeviceUsg").alias("pipeLine"), F.lit("anomalyDetection").alias("phase"),
        common.start_of().alias("sendTime"), data.alias("data"))))
