"""Places of rows in a total order, without one task for a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .work import Work


def numbered(df: DataFrame, group: list[str], order: list[str], work: Work) -> DataFrame:
    """The rows with `idx`, their place from 0 within their group by `order`, and `n`, the group's rows.

    The table is cut into ranges of (group, order), which is written down, so that a lost executor finds the same cut
    again. Only the counts of (group, range) are summed up ahead; rows are numbered within one range of one group. `group`
    and `order` together should tell rows apart (`tie` of the caller), or equal ones share a range. Group columns have no nulls;
    nulls of `order` come first.
    """
    cut = work.keep(df.repartitionByRange(*group, *order).withColumn("part", F.spark_partition_id()), "ranges")
    each = cut.groupBy(*group, "part").agg(F.count("*").alias("here"))
    ahead = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = each.select(
        *group, "part", F.coalesce(F.sum("here").over(ahead), F.lit(0).cast("long")).alias("before"),
        F.sum("here").over(Window.partitionBy(*group)).alias("n"))
    within = F.row_number().over(Window.partitionBy(*group, "part").orderBy(*order))
    return (
        cut.withColumn("idx", within.cast("long") - 1).join(counts, [*group, "part"])
        .withColumn("idx", F.col("idx") + F.col("before")).drop("before", "part"))
