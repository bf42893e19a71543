"""What the monitors share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import add_days, business_day, relative_day
from ..sources.tables import relation_names


def monitored_day(day: str | None, run_day: str | None = None) -> str:
    """The day before the run unless a day is named."""
    return day or relative_day("-1 days", run_day)


def days_before(day: str, days: int) -> list[str]:
    """The dates strictly between `days` before a day and the day itself.

    A filter that lists its dates prunes partitions and reads no date text row by row.
    """
    return [add_days(day, -n) for n in range(days - 1, 0, -1)]


def business_days_before(day: str, days: int) -> list[str]:
    return [d for d in days_before(day, days) if business_day(d)]


def like_days_before(day: str, days: int) -> list[str]:
    """Business days when the monitored day is one, other days when it is not."""
    return [d for d in days_before(day, days) if business_day(d) == business_day(day)]


def within(df: DataFrame, time: str, day: str, days: int = 1) -> DataFrame:
    """Rows of the `days` up to and including a day, by a range of their time that a scan can skip data by."""
    since, until = (F.lit(f"{add_days(day, n)} 00:00:00").cast(df.schema[time].dataType) for n in (1 - days, 1))
    return df.where((F.col(time) >= since) & (F.col(time) < until))


def of_orgs(df: DataFrame, orgs: Sequence[str], column: str = "orgid") -> DataFrame:
    return df.where(F.col(column).isin(list(orgs)))


def of_relations(df: DataFrame, relations: str | Sequence[str]) -> DataFrame:
    return df.where(F.col("relation_name").isin(relation_names(relations)))


def message(metrics: Column) -> list[Column]:
    """The envelope of an alert message."""
    return [F.lit("crs").alias("component"), F.lit("metrics").alias("eventtype"), metrics.alias("metrics")]


def start_of(column: str = "pdate") -> Column:
    return F.concat(F.col(column).cast("string"), F.lit("T00:00:00Z"))
