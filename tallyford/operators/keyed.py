"""Rows with a primary key: newest row, merge and delete."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_write(df: DataFrame, keys: Sequence[str], order: Column | None = None) -> DataFrame:
    """One row per key: the one with the highest order, by its content where that ties.

    A partial maximum per task comes first, so many copies of one key do not meet in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    row = F.struct(*rest)
    rank = row if order is None else F.struct(order, row)
    best = df.groupBy(*keys).agg(F.max_by(row, rank).alias("_row"))
    return best.select(*keys, "_row.*").select(df.columns)


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


def merge_by_key(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert by columns: a column the updates carry wins, null included; others keep their value.

    Both sides hold a key at most once, so no join partition can run hot.
    """
    old = target.withColumn("_in_old", F.lit(True)).alias("old")
    new = updates.withColumn("_in_new", F.lit(True)).alias("new")
    joined = old.join(new, same_keys("old", "new", keys), "full_outer")
    written = F.col("new._in_new").isNotNull()
    columns = []
    for field in target.schema.fields:
        name = field.name
        value = F.col(f"old.{name}")
        if name in updates.columns:
            value = F.when(written, F.col(f"new.{name}").cast(field.dataType)).otherwise(value)
        columns.append(value.alias(name))
    columns += [F.col(f"new.{c}").alias(c) for c in updates.columns if c not in target.columns]
    return joined.select(columns)


def delete_by_key(target: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not among the doomed ones."""
    named = doomed.select(*keys).distinct().alias("doomed")
    return target.alias("kept").join(named, same_keys("kept", "doomed", keys), "left_anti")
