"""Backfill of a date range in one job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import period_days, period_start_day, period_starts
from ..sources.files import read_partitions


def backfill(
    spark: SparkSession, path: str, fmt: str, key: str, start: str, end: str, period: str,
    transform: Callable[[DataFrame], DataFrame],
) -> DataFrame | None:
    """Read all periods that a date range touches as one scan and transform them at once; None without data.

    The input carries its period as `period_start`, by which the transform groups; that replaces
    one read and one job per period.
    """
    days = [d for first in period_starts(start, end, period) for d in period_days(first, period)]
    rows = read_partitions(spark, path, fmt, key, days)
    if rows is None:
        return None
    return transform(rows.withColumn("period_start", period_start_day(F.col(key).cast("string"), period)))
