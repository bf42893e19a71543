"""Top rows per group and overall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_ranked(df: DataFrame, group: Sequence[str], score: Column, k: int) -> DataFrame:
    """Rows whose dense rank by descending score within their group is at most k, ties included.

    A group's rows never meet in one task: only its distinct scores are ranked (cut to k per task
    before the shuffle), and the k-th score comes back as the group's floor. The join with the
    floors is an equi-join that AQE splits where a group is hot.
    """
    rows = df.withColumn("_score", score)
    levels = rows.select(*group, "_score").distinct()
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("_score").desc_nulls_last()))
    floors = (
        levels.withColumn("_rank", rank)
        .where(F.col("_rank") <= k)
        .groupBy(*group)
        .agg(F.min("_score").alias("_floor"), F.max(F.col("_score").isNull()).alias("_open"))
    )
    inside = (F.col("_score") >= F.col("_floor")) | (F.col("_score").isNull() & F.col("_open"))
    return rows.join(floors, list(group)).where(inside).drop("_score", "_floor", "_open")


def top_n(df: DataFrame, n: int, score: str, tie_breaker: str) -> DataFrame:
    """The n rows with the highest score; the tie breaker makes the choice repeatable."""
    return df.orderBy(F.col(score).desc(), F.col(tie_breaker)).limit(n)
