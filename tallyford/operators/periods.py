"""Aggregates per day, week or month; one definition for batch and stream.

Time is cut to the period first and the cut column carries the watermark, so a stream can drop
the state of closed periods; rows later than the period's delay are left out. In batch the
watermark has no effect.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import event_key
from ..functions.times import WATERMARK_DELAY, check_period, period_start, period_tag

WATERMARK_MARK = "spark.watermarkDelayMs"


def mark(df: DataFrame, column: str, period: str) -> DataFrame:
    """Put the period's watermark on a time column."""
    return df.withWatermark(column, WATERMARK_DELAY[check_period(period)])


def is_marked(df: DataFrame) -> bool:
    return any(WATERMARK_MARK in f.metadata for f in df.schema.fields)


def cut(df: DataFrame, period: str, columns: Sequence[Column | str], time: str = "time_stamp") -> DataFrame:
    """The period start as `time_stamp`, watermarked, and the named columns."""
    cut_time = period_start(time, period).alias("time_stamp")
    return mark(df.select(cut_time, *columns), "time_stamp", period)


def labelled(df: DataFrame, period: str, relation: str, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Add the composite `eventKey`, the period and the relation name."""
    tag = period_tag(period)
    return df.select(
        event_key("time_stamp", *keys, F.lit(relation), tag).alias("eventKey"),
        "time_stamp",
        *keys,
        *measures,
        tag.alias("period"),
        F.lit(relation).alias("relation_name"),
    )


def distinct_count(
    df: DataFrame, period: str, keys: Sequence[str], item: str, into: str, relation: str, time: str = "time_stamp"
) -> DataFrame:
    """How many different items each key has in each period; null items do not count.

    The rows shuffle on (period, keys, item), so a hot key spreads over its items; the count per
    key then combines partial counts only.
    """
    rows = cut(df, period, [*keys, item], time).dropDuplicates(["time_stamp", *keys, item])
    counts = rows.groupBy("time_stamp", *keys).agg(F.count(item).alias(into))
    return labelled(counts, period, relation, keys, [into])


def sums(
    df: DataFrame, period: str, keys: Sequence[str], measures: dict[str, Column], relation: str,
    time: str = "time_stamp"
) -> DataFrame:
    """Aggregates per key and period, combined on the map side."""
    needed = [c for c in df.columns if c != time and c != "time_stamp"]
    rows = cut(df, period, [F.col(f"`{c}`") for c in needed], time)
    totals = rows.groupBy("time_stamp", *keys).agg(*[m.alias(n) for n, m in measures.items()])
    return labelled(totals, period, relation, keys, list(measures))


def tumbling(df: DataFrame, time: str, period: str, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Event-time windows of a day or a Sunday week; months have no fixed width and are cut instead."""
    check_period(period)
    if period == "monthly":
        rest = [F.col(f"`{c}`") for c in df.columns if c not in (time, "time_stamp")]
        return cut(df, period, rest, time).groupBy("time_stamp", *keys).agg(*aggregates)
    width, offset = {"daily": ("1 day", "0 days"), "weekly": ("7 days", "3 days")}[period]
    grouped = mark(df, time, period).groupBy(F.window(time, width, startTime=offset).alias("_window"), *keys)
    return grouped.agg(*aggregates).withColumn("time_stamp", F.col("_window.start")).drop("_window")
