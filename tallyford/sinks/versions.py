"""Files with versions: a stream's updates and complete results as files that readers always see whole."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.keyed import last_write, merge_by_key
from ..session import remove_path
from ..sources.files import read_whole_text

POINTERS, ALL = "_versions", "all"
PART = "_part"


class VersionedFiles:
    """A folder of files in which every batch of a stream makes a version.

    A batch writes its files to a folder of its own and then one small pointer file that lists, for each value of
    `partition_key`, the folder that holds it. A batch without a pointer was never there: readers take the newest pointer, and a batch
    that runs again, after a crash too, overwrites its own folder and starts from the version before it. So a repeated batch
    leaves the same files.

    `append` adds the batch's rows. `complete` puts them in the place of all. `update` merges them by `keys`: only the partitions
    that the batch touches are read and written again. The driver lists the partitions: use a period, not a user.
    """

    def __init__(self, path: str, fmt: str = "parquet", keys: Sequence[str] = (), partition_key: str | None = None):
        self.path, self.fmt, self.keys, self.partition_key = path.rstrip("/"), fmt, list(keys), partition_key

    def _system(self, spark: SparkSession, path: str):
        to = spark._jvm.org.apache.hadoop.fs.Path(path)
        return to.getFileSystem(spark._jsc.hadoopConfiguration()), to

    def versions(self, spark: SparkSession) -> list[int]:
        """The numbers of the versions that are there, in order."""
        system, folder = self._system(spark, f"{self.path}/{POINTERS}")
        if not system.exists(folder):
            return []
        names = [status.getPath().getName() for status in system.listStatus(folder)]
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())

    def pointer(self, spark: SparkSession, version: int) -> dict:
        """What a version consists of: `schema`, and `parts`, the folders of each partition value."""
        return json.loads(read_whole_text(spark, f"{self.path}/{POINTERS}/{version:012d}.json"))

    def _point(self, spark: SparkSession, version: int, content: dict) -> None:
        system, final = self._system(spark, f"{self.path}/{POINTERS}/{version:012d}.json")
        _, draft = self._system(spark, f"{self.path}/{POINTERS}/.{version:012d}.draft")
        out = system.create(draft, True)
        out.write(json.dumps(content, sort_keys=True).encode())
        out.close()
        if not system.rename(draft, final):
            raise OSError(f"cannot write version {version} of {self.path}")

    def _load(self, spark: SparkSession, content: dict, parts: Sequence[str] | None = None) -> DataFrame:
        schema = StructType.fromJson(content["schema"])
        names = content["parts"] if parts is None else [p for p in parts if p in content["parts"]]
        folders = sorted({f"{self.path}/{folder}" for name in names for folder in content["parts"][name]})
        reader = spark.read.schema(schema).format(self.fmt)
        if self.fmt == "csv":
            reader = reader.option("header", "true")
        return reader.load(folders) if folders else spark.createDataFrame([], schema)

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The rows of the newest version, or of a given one."""
        there = self.versions(spark)
        if not there:
            raise ValueError(f"{self.path} has no version yet")
        return self._load(spark, self.pointer(spark, there[-1] if version is None else version))

    def write(self, batch: DataFrame, number: int, mode: str) -> None:
        """Make the version of a batch, unless it is there."""
        spark = batch.sparkSession
        if mode == "update" and not self.keys:
            raise ValueError("update mode needs the keys that rows are merged by")
        there = self.versions(spark)
        if number in there:
            return
        before = [v for v in there if v < number]
        old = self.pointer(spark, before[-1]) if before else None
        base = f"batch-{number:012d}"
        part = F.coalesce(F.col(self.partition_key).cast("string"), F.lit("null")) if self.partition_key else F.lit(ALL)
        rows = last_write(batch, self.keys) if mode == "update" else batch
        # What a version says of its partitions must be what its files hold: the batch is read once, into its folder.
        rows.withColumn(PART, part).hint("rebalance", PART).write.mode("overwrite").format("parquet").partitionBy(PART).save(
            f"{self.path}/.{base}")
        staged = spark.read.schema(rows.withColumn(PART, F.lit("")).schema).parquet(f"{self.path}/.{base}")
        touched = sorted(self._folders(spark, f".{base}"))
        new = staged.drop(PART)
        if mode == "update" and old:
            new = merge_by_key(self._load(spark, old, touched), new, self.keys)
        writer = new.withColumn(PART, part).hint("rebalance", PART).write.mode("overwrite").format(self.fmt).partitionBy(PART)
        (writer.option("header", "true") if self.fmt == "csv" else writer).save(f"{self.path}/{base}")
        remove_path(spark, f"{self.path}/.{base}")
        made = {name: [f"{base}/{folder}"] for name, folder in self._folders(spark, base).items()}
        kept = dict(old["parts"]) if old and mode != "complete" else {}
        if mode == "append":
            made = {name: [*kept.get(name, []), *folders] for name, folders in made.items()}
        self._point(spark, number, {"schema": json.loads(new.schema.json()), "parts": {**kept, **made}})

    def _folders(self, spark: SparkSession, base: str) -> dict[str, str]:
        system, folder = self._system(spark, f"{self.path}/{base}")
        names = [s.getPath().getName() for s in system.listStatus(folder) if s.isDirectory()] if system.exists(folder) else []
        return {name[len(PART) + 1:]: name for name in names if name.startswith(f"{PART}=")}

    def expire(self, spark: SparkSession, keep: int = 10) -> None:
        """Remove all but the newest versions, and folders that only those removed had."""
        there = self.versions(spark)
        gone, stay = there[:-keep], there[-keep:]
        used = {f.split("/")[0] for v in stay for folders in self.pointer(spark, v)["parts"].values() for f in folders}
        lost = {f.split("/")[0] for v in gone for folders in self.pointer(spark, v)["parts"].values() for f in folders} - used
        for version in gone:
            remove_path(spark, f"{self.path}/{POINTERS}/{version:012d}.json")
        for folder in lost:
            remove_path(spark, f"{self.path}/{folder}")
