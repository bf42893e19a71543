"""Session settings that every job relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# UTC everywhere: event times, period starts and formatted days share one zone.
# AQE sizes shuffles, turns joins with a small measured side into broadcast
# joins and splits hot join partitions, even when a later operator then needs
# another shuffle.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Stream state lives on local disk and checkpoints only its changes.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.orc.filterPushdown": "true",
    "spark.sql.orc.enableVectorizedReader": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session someone else built."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build(app_name: str, master: str | None = None, codecs: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; `codecs` names extra Hadoop compression codecs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if codecs:
        builder = builder.config("spark.hadoop.io.compression.codecs", codecs)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the session's checkpoint directory.

    Where it is unset, a local session gets a temporary one; a cluster has to name its own,
    because a folder on one machine is lost with that machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if named is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
            named = tempfile.mkdtemp(prefix="tallyford-")
        sc.setCheckpointDir(named)
    return named or sc.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for staging tables and stream checkpoints."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """A frame written to the shared folder, which cuts its lineage, and removed after use."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_path(spark, path)


def remove_path(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def leaf_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Names of the folders at a depth below a path, relative to it; hidden ones and files are left out."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [("", root)]
    for _ in range(depth):
        below = [(name, s.getPath()) for name, folder in found for s in fs.listStatus(folder) if s.isDirectory()]
        found = [(f"{name}/{p.getName()}".lstrip("/"), p) for name, p in below if not p.getName().startswith((".", "_"))]
    return [name for name, _ in found if name]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or any match of a glob, exists on its file system."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    matches = fs.globStatus(jvm_path)
    return matches is not None and len(matches) > 0


def replace_path(spark: SparkSession, path: str, new: str, old: str) -> None:
    """Put a finished folder in the place of another, which is kept as `old` until the new one is there."""
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = to_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(to_path(path)):
        fs.delete(to_path(old), True)
        if not fs.rename(to_path(path), to_path(old)):
            raise OSError(f"cannot move {path} aside")
    if not fs.rename(to_path(new), to_path(path)):
        raise OSError(f"cannot move {new} to {path}")
    fs.delete(to_path(old), True)
