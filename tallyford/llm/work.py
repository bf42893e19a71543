"""Intermediate tables in the folder all executors share, and files that tasks write there."""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

from ..session import fresh_path, shared_folder


def hadoop(spark: SparkSession, path: str):
    """The file system and path object that the JVM uses for a path."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


# Spark removes a query's shuffle files when the query ends, not when the driver's garbage collection finds them.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Work:
    """Tables that last as long as an operator runs.

    `keep` writes a frame to the shared folder, which cuts its lineage: a lost executor costs the tasks that
    ran on it, not the steps before, and the step's shuffle files go at once. All tables go when the block ends, so a
    result has to be made whole with `result` first.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, fresh_path(spark, name)

    def __enter__(self) -> Work:
        self.removes = self.spark.conf.get(REMOVE_SHUFFLES, None)
        self.spark.conf.set(REMOVE_SHUFFLES, "true")
        return self

    def __exit__(self, *_) -> None:
        if self.removes is None:
            self.spark.conf.unset(REMOVE_SHUFFLES)
        else:
            self.spark.conf.set(REMOVE_SHUFFLES, self.removes)
        system, path = hadoop(self.spark, self.root)
        system.delete(path, True)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def keep(self, df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
        path = self.path(name)
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Remove a table that is no longer needed before the block ends."""
        for file in df.inputFiles()[:1]:
            system, path = hadoop(self.spark, file)
            system.delete(path.getParent(), True)


def result(df: DataFrame) -> DataFrame:
    """The frame computed now and kept in the checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system and path of a folder, from a URI or an absolute path."""
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri[len("file:"):]
    return pafs.LocalFileSystem(), uri
