"""Reads of wide-column tables and document indexes, by partition predicates."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.times import add_days

WIDE_COLUMN_FORMAT = "org.apache.spark.sql.cassandra"
DOCUMENT_FORMAT = "org.elasticsearch.spark.sql"


# Setting name and the connector option it becomes.
WIDE_OPTIONS = {
    "table": "table",
    "keyspace": "keyspace",
    "host": "spark.cassandra.connection.host",
    "port": "spark.cassandra.connection.port",
    "local_dc": "spark.cassandra.connection.localDC",
    "username": "spark.cassandra.auth.username",
    "password": "spark.cassandra.auth.password",
    "readTimeout": "spark.cassandra.read.timeoutMS",
}


def wide_options(settings: Mapping) -> dict[str, str]:
    """Connector options of a table; unset and empty settings are left to the session."""
    options = {option: str(settings[name]) for name, option in WIDE_OPTIONS.items() if settings.get(name)}
    if settings.get("consistencyLevel"):
        for side in ("input", "output"):
            options[f"spark.cassandra.{side}.consistency.level"] = settings["consistencyLevel"]
    return {**options, **settings.get("options", {})}


def read_wide_table(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A whole table through the connector the cluster supplies."""
    return spark.read.format(WIDE_COLUMN_FORMAT).options(**options).load()


def relation_names(relations: str | Sequence[str]) -> list[str]:
    names = relations.split(",") if isinstance(relations, str) else relations
    return [n.strip() for n in names]


def any_key(day: str, relations: str | Sequence[str]) -> Column:
    """Rows of a day that belong to one of the relations, as OR-joined key predicates."""
    keys = [(F.col("pdate") == day) & (F.col("relation_name") == r) for r in relation_names(relations)]
    return functools.reduce(operator.or_, keys)


def in_days(df: DataFrame, time_column: str, first: str, until: str) -> DataFrame:
    """Rows of a time from one day up to before another: a range that a scan skips data by, unlike a day worked out from the time."""
    since, end = (F.lit(f"{day} 00:00:00").cast(df.schema[time_column].dataType) for day in (first, until))
    return df.where((F.col(time_column) >= since) & (F.col(time_column) < end))


def month_after(month: str) -> str:
    year, number = map(int, month.split("-"))
    return f"{year + number // 12:04d}-{number % 12 + 1:02d}"


def select_rows(
    df: DataFrame, day: str | None = None, relations: str | Sequence[str] | None = None, month: str | None = None,
    month_partition: bool = False, whole_month: bool = False, day_column: str = "pdate", time_column: str | None = None,
) -> DataFrame:
    """Rows by month, day and relation, as predicates on the partition columns.

    `month_partition` selects month and day without relations; `whole_month` the relations of all
    days. Several relations are one scan. A table keyed by month and time takes
    `day_column='time_stamp'`. Where day and month are worked out from a time the frame still has, `time_column` names it, and
    the day or month is also asked for as a range of that time.
    """
    if month:
        df = df.where(F.col("month") == month)
        if time_column:
            df = in_days(df, time_column, f"{month}-01", f"{month_after(month)}-01")
    if day is None:
        return df
    if time_column:
        df = (in_days(df, time_column, f"{day[:7]}-01", f"{month_after(day[:7])}-01") if whole_month
              else in_days(df, time_column, day, add_days(day, 1)))
    if month_partition:
        return df.where((F.col("month") == day[:7]) & (F.col("pdate") == day))
    if relations is None:
        raise ValueError("a read by day needs relations, or month_partition")
    wanted = F.col("relation_name").isin(relation_names(relations))
    if whole_month:
        return df.where(wanted)
    if day_column == "time_stamp":
        return df.where((F.col("month") == day[:7]) & (F.col("time_stamp") == F.lit(day).cast("timestamp")) & wanted)
    return df.where((F.col(day_column) == day) & wanted)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def read_documents(spark: SparkSession, options: Mapping[str, str], schema: StructType | None = None) -> DataFrame:
    """A document index, with its schema or the connector's inferred one."""
    reader = spark.read.format(DOCUMENT_FORMAT).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load()


def write_documents(df: DataFrame, options: Mapping[str, str], append: bool = True) -> bool:
    """Write to a document index unless there is nothing to write; tells whether it wrote."""
    if df.isEmpty():
        return False
    df.write.format(DOCUMENT_FORMAT).options(**options).mode("append" if append else "overwrite").save()
    return True
