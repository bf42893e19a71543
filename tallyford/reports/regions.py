"""Users by the region of their organisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_region(users: DataFrame, regions: DataFrame, region: str = "EU", key: str = "orgId") -> DataFrame:
    return users.join(regions.where(F.col("region") == region).select(key), key, "left_semi")


def outside_region(users: DataFrame, regions: DataFrame, region: str = "EU", key: str = "orgId") -> DataFrame:
    return users.join(regions.where(F.col("region") == region).select(key), key, "left_anti")


def without_region(users: DataFrame, regions: DataFrame, key: str = "orgId") -> DataFrame:
    """Organisations no region is known for."""
    return users.select(key).join(regions.select(key), key, "left_anti")
