"""Joins of facts with lookup lists and mapping tables.

No join here carries a broadcast hint. Spark checks the size itself: a side below
`spark.sql.autoBroadcastJoinThreshold` is broadcast at planning time, a side measured below
it at run time likewise, and beyond it AQE runs a sort-merge join whose hot partitions it splits.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import as_column


def literal_rows(spark: SparkSession, columns: Mapping[str, Sequence]) -> DataFrame:
    """A small literal table; goes into the plan as a local relation of known size."""
    return spark.createDataFrame(pa.table({name: pa.array(list(v)) for name, v in columns.items()}))


def member_list(spark: SparkSession, members: Iterable[str], key: str) -> DataFrame:
    return spark.createDataFrame(pa.table({key: pa.array(list(members), pa.string())}))


def mapping_table(spark: SparkSession, pairs: Mapping[str, str]) -> DataFrame:
    """(key, value) rows of a dict."""
    return spark.createDataFrame(pa.table({
        "key": pa.array(list(pairs), pa.string()), "value": pa.array(list(pairs.values()), pa.string())}))


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """A two-column CSV with a header as (key, value)."""
    return spark.read.csv(path, header=True).toDF("key", "value").na.fill("", ["key"])


def look_up(df: DataFrame, mapping: DataFrame, key: Column | str, into: str, default: str) -> DataFrame:
    """Add column `into`: the mapping's value for the key, `default` without one; a null key reads as `''`."""
    unique = mapping.groupBy(F.col("key").alias("_key")).agg(F.max("value").alias(into))
    return (
        df.withColumn("_key", F.coalesce(as_column(key), F.lit("")))
        .join(unique, "_key", "left")
        .drop("_key")
        .withColumn(into, F.coalesce(F.col(into), F.lit(default)))
    )


def endpoint_class(df: DataFrame, mapping: DataFrame, device: str, agent: str, into: str = "ep1") -> DataFrame:
    """Endpoint class of `device|agent`, `Other` when unmapped."""
    key = F.concat(F.coalesce(F.col(device), F.lit("")), F.lit("|"), F.coalesce(F.col(agent), F.lit("")))
    return look_up(df, mapping, key, into, "Other")


def agent_category(df: DataFrame, mapping: DataFrame, agent: str, into: str = "ua_category") -> DataFrame:
    """Category of a user agent, `OTHER` when unmapped."""
    return look_up(df, mapping, agent, into, "OTHER")


def flag_members(df: DataFrame, members: DataFrame, key: str, into: str, hit=1, miss=0) -> DataFrame:
    """Add `into`: `hit` for rows whose key is in the list, else `miss`."""
    listed = members.select(F.col(members.columns[0]).alias(key)).distinct().withColumn("_hit", F.lit(True))
    return (
        df.join(listed, key, "left")
        .withColumn(into, F.when(F.col("_hit"), F.lit(hit)).otherwise(F.lit(miss)))
        .drop("_hit")
    )


def keep_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the list."""
    return df.join(members.select(F.col(members.columns[0]).alias(key)), key, "left_semi")


def drop_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the list."""
    return df.join(members.select(F.col(members.columns[0]).alias(key)), key, "left_anti")


def excluded_orgs(orgs: DataFrame) -> DataFrame:
    """The organisations a CSV (org_id, exclude) marks for exclusion."""
    return orgs.where(F.col("exclude").cast("int") == 1).select("org_id")


def with_every_group(groups: DataFrame, counts: DataFrame, on: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per group; groups without counts get 0."""
    return groups.join(counts, list(on), "left").na.fill(0, list(measures))
