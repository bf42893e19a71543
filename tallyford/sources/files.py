"""File sources: plain, dated and streaming reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from ..functions.times import period_days
from ..operators.sets import balanced_union
from ..operators.shaping import retype
from ..session import path_exists


def input_names(inputs: str | Sequence[str]) -> list[str]:
    """Names of a list or of a comma text, blanks removed."""
    return ["".join(i.split()) for i in (inputs.split(",") if isinstance(inputs, str) else inputs)]


def _join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *[p.strip("/") for p in parts if p]])


def _options(fmt: str, multiline: bool, tab: bool, base: str | None = None) -> dict:
    options = {"multiLine": str(multiline).lower()} if fmt in ("json", "csv") else {}
    if tab:
        options["delimiter"] = "\t"
    if base:
        options["basePath"] = base
    return options


def _json_rows(frame: DataFrame, schema: StructType) -> DataFrame:
    """Rows of JSON files read with a schema and a `value` column: wrapped documents are parsed.

    A wrapped document's text is kept as `raw`. The choice is made per row, so the files are read
    once and never scanned to infer their schema.
    """
    plain = F.struct(*[F.col(f"`{name}`") for name in schema.fieldNames()])
    inner = F.when(F.col("value").isNotNull(), F.from_json("value", schema)).otherwise(plain)
    raw = [] if "raw" in schema.fieldNames() else [F.coalesce("value", "raw").alias("raw")]
    return frame.select(inner.alias("data"), *raw).select("data.*", *["raw"] * len(raw))


def _json_schema(schema: StructType) -> StructType:
    extra = [StructField(n, StringType()) for n in ("value", "raw") if n not in schema.fieldNames()]
    return StructType([*schema.fields, *extra])


def _load(spark: SparkSession, fmt: str, paths: list[str], schema: StructType | None, options: dict) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    if schema is None:
        return reader.load(paths)
    if fmt == "csv":
        return reader.schema(schema).load(paths)
    if fmt == "json" and "value" not in schema.fieldNames():
        return _json_rows(reader.schema(_json_schema(schema)).load(paths), schema)
    return retype(reader.load(paths), schema)


def read_files(
    spark: SparkSession, root: str, inputs: str | Sequence[str], fmt: str, schema: StructType | None = None,
    multiline: bool = False, tab: bool = False,
) -> DataFrame | None:
    """Union of the inputs under a root; absent ones are left out, None when all are.

    Inputs may be folders, files or globs. A schema types CSV and JSON while reading and is
    projected onto the other formats; JSON text in a `value` column is parsed with it.
    """
    paths = [_join(root, name) for name in input_names(inputs)]
    present = [p for p in paths if path_exists(spark, p)]
    if not present:
        return None
    options = _options(fmt, multiline, tab)
    if schema is not None:
        return _load(spark, fmt, present, schema, options)
    # Without a schema each input keeps its own columns; the union fills the gaps.
    return balanced_union([_load(spark, fmt, [p], None, options) for p in reversed(present)])


def read_period(
    spark: SparkSession, root: str, inputs: str | Sequence[str], fmt: str, day: str | Sequence[str], period: str | None = None,
    partition_key: str | None = None, schema: StructType | None = None, base_path: bool = False,
    alias: str | None = None, alias_column: str | None = None, multiline: bool = False, tab: bool = False,
) -> DataFrame | None:
    """The dated folders of the period around a day, or around each of several days, absent ones left out.

    A folder is `key=<date>`, `<date>` or `alias % <date>`. All folders of an input are one scan.
    `base_path` brings back the partition column; otherwise `alias_column` adds the day as text.
    """
    days = [day] if isinstance(day, str) else list(day)
    if alias_column and not base_path and len(days) > 1:
        raise ValueError("one day cannot be added to the rows of several periods; use the base path")
    folders = [
        alias.replace("%s", d) if alias else f"{partition_key}={d}" if partition_key else d
        for d in dict.fromkeys(d for one in days for d in period_days(one, period))
    ]
    frames = []
    for name in input_names(inputs):
        paths = [p for p in (_join(root, name, f) for f in folders) if path_exists(spark, p)]
        if paths:
            base = _join(root, name) if base_path else None
            frames.append(_load(spark, fmt, paths, schema, _options(fmt, multiline, tab, base)))
    if not frames:
        return None
    result = balanced_union(frames[::-1])
    if alias_column and not base_path:
        result = result.withColumn(alias_column, F.lit(days[0]))
    return result


def read_partitions(spark: SparkSession, path: str, fmt: str, key: str, days: Sequence[str]) -> DataFrame | None:
    """Days of a `key=<date>` folder tree as one scan that lists only those folders; None without any."""
    present = [p for p in (_join(path, f"{key}={day}") for day in days) if path_exists(spark, p)]
    if not present:
        return None
    return spark.read.format(fmt).option("basePath", path).load(present)


TEXT_VALUE = StructType([StructField("value", StringType())])


def stream_files(
    spark: SparkSession, root: str, inputs: str | Sequence[str], fmt: str, schema: StructType | None = None,
    multiline: bool = False, max_files: int | None = None, folders: Sequence[str] = ("",),
) -> DataFrame:
    """New files under the inputs as a stream. Spark needs the schema up front; text needs none."""
    if schema is None:
        if fmt != "text":
            raise ValueError(f"a stream of {fmt} files needs a schema")
        schema = TEXT_VALUE
    wrapped = fmt == "json" and "value" not in schema.fieldNames()
    reader = spark.readStream.format(fmt).schema(_json_schema(schema) if wrapped else schema).options(**_options(fmt, multiline, False))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    streams = [reader.load(_join(root, name, folder)) for name in input_names(inputs) for folder in folders]
    rows = balanced_union(streams[::-1])
    return _json_rows(rows, schema) if wrapped else rows


def stream_period(
    spark: SparkSession, root: str, inputs: str | Sequence[str], fmt: str, day: str, period: str | None = None,
    partition_key: str | None = None, **options,
) -> DataFrame:
    """As `read_period`, streaming; without aliases and tab-separated files."""
    folders = [f"{partition_key}={d}" if partition_key else d for d in period_days(day, period)]
    return stream_files(spark, root, inputs, fmt, folders=folders, **options)


def read_whole_text(spark: SparkSession, path: str) -> str:
    """One small text file, such as a SQL statement file, with its lines in order."""
    return spark.read.text(path, wholetext=True).head()[0]
