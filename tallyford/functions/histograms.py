"""Averages over histogram arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .times import as_column


def average_of_minima(bins: Column | str) -> Column:
    """Mean of `min + 1` over array<struct<duration,min,..>>, weighted by duration.

    0 for a null or empty array and for a total duration of 0.
    """
    bins = as_column(bins)
    zero = F.lit(0).cast("bigint")
    start = F.struct(zero.alias("total"), zero.alias("weight"))

    def add(acc: Column, b: Column) -> Column:
        return F.struct((acc["total"] + b["duration"] * (b["min"] + 1)).alias("total"), (acc["weight"] + b["duration"]).alias("weight"))

    mean = F.aggregate(bins, start, add, lambda acc: F.try_divide(acc["total"].cast("double"), acc["weight"]))
    return F.coalesce(mean, F.lit(0.0))
