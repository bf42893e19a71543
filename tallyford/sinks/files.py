"""File sinks for batch results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import remove_path, replace_path
from ..sources.modes import save_mode

# Most rows of a summary, which one task writes.
SUMMARY_ROWS = 100_000


def write_files(df: DataFrame, path: str, fmt: str, mode: str, partition_key: str | Sequence[str] | None = None) -> None:
    """Write files, partitioned when a key or several are given.

    The rebalance hint gathers a partition's rows into well-sized files and splits a hot partition.
    """
    keys = [partition_key] if isinstance(partition_key, str) else list(partition_key or [])
    if keys:
        df = df.hint("rebalance", *keys)
    writer = df.write.mode(save_mode(mode)).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if keys:
        writer = writer.partitionBy(*keys)
    writer.save(path)


def write_summary(df: DataFrame, path: str, max_rows: int = SUMMARY_ROWS) -> None:
    """One CSV file of a small summary; the upstream work keeps its parallelism.

    One task writes it, so a frame of more than `max_rows` rows is refused and the summary that was there stays.
    """
    spark, new, seen = df.sparkSession, f"{path.rstrip('/')}.new", Observation()
    # A limit leaves one partition.
    df.limit(max_rows + 1).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").csv(new)
    if seen.get["rows"] > max_rows:
        remove_path(spark, new)
        raise ValueError(f"a summary of more than {max_rows} rows: write it with write_files")
    replace_path(spark, path, new, f"{path.rstrip('/')}.old")
