"""The registered queries and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ..session import prepare


@dataclass
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL that gives the same rows."""

    def add(build):
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepare(spark), sf_dir)

        QUERIES[name] = Query(prepared, sql)
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, its zone-less times as timestamps."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select([
        F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, TimestampNTZType) else F.col(f.name)
        for f in df.schema.fields
    ])


def text_time(column: str = "time_stamp"):
    """A time as text, which both engines print alike."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def with_text_time(df: DataFrame, column: str = "time_stamp") -> DataFrame:
    return df.withColumn(column, text_time(column))
