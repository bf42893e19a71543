"""Unions, differences and unpivoting."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def balanced_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column one side lacks is null there. Duplicates stay."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def positional_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by position. Duplicates stay."""
    return functools.reduce(DataFrame.unionAll, frames)


def difference(left: DataFrame, right: DataFrame, keep_duplicates: bool = False) -> DataFrame:
    """Rows of left that are not in right: as a set, or with their multiplicity."""
    return left.exceptAll(right) if keep_duplicates else left.subtract(right)


def complement(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which a condition does not hold, null results included."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def measures_to_rows(
    df: DataFrame, keep: Sequence[str], measures: Mapping[str, Column], name: str = "measure", value: str = "value"
) -> DataFrame:
    """One row per measure and input row, in one pass."""
    cells = F.array(*[
        F.struct(F.lit(label).alias(name), column.cast("double").alias(value)) for label, column in measures.items()
    ])
    return df.select(*keep, F.inline(cells))
