"""The registered queries of this subpackage and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def ship(spark: SparkSession) -> SparkSession:
    """Fit Arrow batches to texts and send the package to the Python workers, unless their path has it."""
    sc = spark.sparkContext
    # Texts are long: 10,000 of them in a batch fill a worker's memory.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    if ROOT not in os.environ.get("PYTHONPATH", "").split(os.pathsep) and not getattr(sc, "_tallyford_shipped", False):
        folder = tempfile.mkdtemp()
        atexit.register(shutil.rmtree, folder, True)
        sc.addPyFile(shutil.make_archive(f"{folder}/tallyford", "zip", ROOT, "tallyford"))
        sc._tallyford_shipped = True
    return spark


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = lambda spark, sf_dir: build(ship(prepare(spark)), sf_dir)
        if sql:
            SQL[name] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
