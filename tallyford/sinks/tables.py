"""Tables: keyed upsert and delete on partitioned files, and insert-overwrite."""

from __future__ import annotations

import threading
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..operators.keyed import delete_by_key, last_write, merge_by_key
from ..operators.shaping import lower_names, table_rows
from ..session import fresh_path, leaf_folders, path_exists, remove_path, replace_path

_TURNS: dict[str, threading.Lock] = {}


def _turn(path: str) -> threading.Lock:
    """The lock of a table's writers: streams of one application may share a table."""
    return _TURNS.setdefault(path, threading.Lock())


@dataclass
class KeyedTable:
    """Files under a path, partitioned by some of the key columns, one row per key.

    An upsert or delete rewrites only the partitions it touches, by a dynamic partition overwrite:
    Spark stages the new files and moves them in when the job is done. A table without partitions is
    written anew next to the old one, which it then replaces. Repeating a write gives the same
    table, so a retried stream batch is harmless. Writers of one application take turns; a table
    must not be written by two applications.

    Updates are staged in the table's own partitions, so the names of the staged folders, the one of null
    values included, are the partitions to read and rewrite, however many there are. A partition value
    cannot be an empty text, which a folder name cannot tell from null.

    An overwrite by partition leaves a partition without new rows as it was, so a delete then removes the
    folders of the partitions that it emptied. A delete that is cut short in between is repeated.
    """

    path: str
    schema: StructType
    keys: list[str]
    partition_by: list[str] = field(default_factory=list)
    fmt: str = "parquet"

    def __post_init__(self):
        if isinstance(self.schema, str):
            self.schema = StructType.fromDDL(self.schema)
        if not set(self.partition_by) <= set(self.keys) <= set(self.schema.fieldNames()):
            raise ValueError("partition columns must be key columns, and keys must be in the schema")

    def read(self, spark: SparkSession) -> DataFrame:
        # Between the two renames of a replacement only the old copy exists.
        path = next((p for p in (self.path, self._old_path) if path_exists(spark, p)), None)
        if path is None:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).format(self.fmt).load(path).select(self.schema.fieldNames())

    def upsert(self, df: DataFrame, order: Column | None = None) -> None:
        """Merge rows by key and column; where a key repeats, the highest order is the last write."""
        spark = df.sparkSession
        newest = last_write(self._typed(table_rows(df)), self.keys, order)
        with self._staged(newest, "updates") as (updates, folders), _turn(self.path):
            target = self._touched(spark, folders)
            if target is None:
                missing = [f for f in self.schema.fields if f.name not in updates.columns]
                rows = updates.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
                self._replace(rows.select(self.schema.fieldNames()))
            else:
                self._replace(merge_by_key(target, updates, self.keys))

    def delete(self, doomed: DataFrame) -> None:
        """Delete the rows whose keys are given; a stream cannot delete."""
        if doomed.isStreaming:
            raise ValueError("rows cannot be deleted by a stream")
        spark = doomed.sparkSession
        keys = self._typed(lower_names(doomed)).select(*self.keys).distinct()
        with self._staged(keys, "doomed") as (doomed, folders), _turn(self.path):
            target = self._touched(spark, folders)
            if target is None:
                return
            kept = delete_by_key(target, doomed, self.keys)
            if not self.partition_by:
                return self._replace(kept)
            filled = kept.select(*self.partition_by).distinct().withColumn("_filled", F.lit(True))
            with self._staged(filled, "filled") as (_, left):
                self._replace(kept)
                for name in set(folders) - set(left):
                    remove_path(spark, f"{self.path.rstrip('/')}/{name}")

    @property
    def _old_path(self) -> str:
        return f"{self.path.rstrip('/')}.old"

    def _typed(self, rows: DataFrame) -> DataFrame:
        names = {n.lower(): n for n in self.schema.fieldNames()}
        unknown = [c for c in rows.columns if c not in names]
        if unknown:
            raise ValueError(f"columns {unknown} are not in the table")
        return rows.select(
            [F.col(f"`{c}`").cast(self.schema[names[c]].dataType).alias(names[c]) for c in rows.columns])

    @contextmanager
    def _staged(self, rows: DataFrame, name: str) -> Iterator[tuple[DataFrame, list[str]]]:
        """Rows written to the shared folder in the table's partitions, and the names of their folders."""
        spark = rows.sparkSession
        for column in self.partition_by:
            if isinstance(self.schema[column].dataType, StringType):
                rows = rows.withColumn(column, F.when(F.col(column) == "", F.raise_error(F.lit(
                    f"empty text in the partition column {column}")).cast("string")).otherwise(F.col(column)))
        path = fresh_path(spark, name)
        rows.write.partitionBy(*self.partition_by).parquet(path)
        try:
            yield spark.read.schema(rows.schema).parquet(path).select(rows.columns), leaf_folders(spark, path, len(self.partition_by))
        finally:
            remove_path(spark, path)

    def _touched(self, spark: SparkSession, folders: list[str]) -> DataFrame | None:
        """The rows of the table's partitions with these folder names; None if there are none of them."""
        if not self.partition_by:
            return self.read(spark) if path_exists(spark, self.path) or path_exists(spark, self._old_path) else None
        there = set(leaf_folders(spark, self.path, len(self.partition_by))) if path_exists(spark, self.path) else set()
        paths = [f"{self.path.rstrip('/')}/{name}" for name in folders if name in there]
        if not paths:
            return None
        rows = spark.read.schema(self.schema).format(self.fmt).option("basePath", self.path).load(paths)
        return rows.select(self.schema.fieldNames())

    def _replace(self, rows: DataFrame) -> None:
        if not self.partition_by:
            spark, new = rows.sparkSession, f"{self.path.rstrip('/')}.new"
            rows.write.mode("overwrite").format(self.fmt).save(new)
            replace_path(spark, self.path, new, self._old_path)
            return
        (rows.hint("rebalance", *self.partition_by).write.mode("overwrite").format(self.fmt)
         .partitionBy(*self.partition_by).option("partitionOverwriteMode", "dynamic").save(self.path))


def create_bucketed_table(df: DataFrame, name: str, partition_key: str, cluster_key: str, buckets: int) -> None:
    """An empty catalog table shaped like a frame: bucketed by the partition key, sorted by the cluster key."""
    split = lambda text: ["".join(c.split()) for c in text.split(",")]
    first, *more = split(partition_key)
    sort_first, *sort_more = split(cluster_key)
    (df.limit(0).write.format("parquet").bucketBy(buckets, first, *more).sortBy(sort_first, *sort_more)
     .saveAsTable(name))


def insert_overwrite(df: DataFrame, table: str, columns: Sequence[str], ddl: str) -> None:
    """Replace the partitions a frame touches in an ORC table, made from its DDL when missing.

    Insertion goes by position, so the columns are projected in table order.
    """
    if df.isStreaming:
        raise ValueError("a stream cannot insert into a table")
    if table not in ddl:
        raise ValueError(f"the DDL does not create {table}")
    spark = df.sparkSession
    spark.sql(ddl)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows = df.selectExpr(*columns)
        # Partition columns come last: one well-sized set of files for each partition.
        parted = sum(c.isPartition for c in spark.catalog.listColumns(table))
        if parted:
            rows = rows.hint("rebalance", *rows.columns[-parted:])
        rows.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)
