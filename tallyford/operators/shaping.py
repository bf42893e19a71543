"""JSON, envelope and column shaping; every function works on batch and streaming frames."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions import times
from ..functions.times import as_column


def parse_value(df: DataFrame, schema: StructType | str, value: str = "value") -> DataFrame:
    """JSON text to columns, the text itself kept as `raw`.

    `inline` makes the parsed columns a generator's output. Plain projected fields would be pulled
    into every later filter, each use parsing the text again.
    """
    return df.select(F.inline(F.array(F.from_json(F.col(value), schema))), F.col(value).alias("raw"))


def schema_of_sample(spark: SparkSession, sample: str) -> StructType:
    """Schema of one JSON sample document."""
    return spark.range(1).select(F.from_json(F.lit(sample), F.schema_of_json(F.lit(sample))).alias("d")) \
        .select("d.*").schema


def schema_of_file(spark: SparkSession, path: str) -> StructType:
    """Schema of a JSON sample document in a file."""
    return spark.read.option("multiLine", True).json(path).schema


def has_column(df: DataFrame, path: str) -> bool:
    """Whether a column, or a dotted path into structs, exists."""
    kind = df.schema
    for name in path.split("."):
        if not isinstance(kind, StructType) or name not in kind.fieldNames():
            return False
        kind = kind[name].dataType
    return True


def retype(df: DataFrame, schema: StructType) -> DataFrame:
    """Project a frame onto a schema: missing columns null, others dropped, `raw` kept.

    A JSON `value` column is parsed instead. Values that do not fit become null.
    """
    if "value" in df.columns and isinstance(df.schema["value"].dataType, StringType):
        return parse_value(df, schema)
    have = set(df.columns)
    columns = [
        (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    if "raw" in have and "raw" not in schema.fieldNames():
        columns.append(F.col("raw").cast("string").alias("raw"))
    return df.select(columns)


def to_json_rows(df: DataFrame, name: str = "value") -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias(name))


def envelope(df: DataFrame, key: str | None = None, value: str | None = None, salt: Column | None = None) -> DataFrame:
    """Message rows: `value` is an expression or the whole row as JSON; a key gets `^` and a salt.

    The salt spreads one key over topic partitions: a random UUID unless a repeatable one is given.
    """
    payload = F.expr(value) if value else F.to_json(F.struct("*"))
    if key is None:
        return df.select(payload.alias("value"))
    salted = F.concat(F.expr(key).cast("string"), F.lit("^"), F.expr("uuid()") if salt is None else salt)
    return df.select(salted.alias("key"), payload.alias("value"))


def unsalted_key(key: Column | str = "key") -> Column:
    return F.substring_index(as_column(key), "^", 1)


def received_time(value: Column | str = "value") -> Column:
    """`timeRcvd` of a JSON text, else `@timestamp`, else `''`."""
    value = as_column(value)
    return F.coalesce(
        F.get_json_object(value, "$.timeRcvd"), F.get_json_object(value, "$['@timestamp']"), F.lit(""))


def unwrap_message(value: Column | str = "value") -> Column:
    """Move the JSON after the first `:` of `@message` into `SM`.

    Documents with an `appname`, and whatever cannot be read, come back as they are.
    """
    value = as_column(value)
    message = F.get_json_object(value, "$['@message']")
    inner = F.try_parse_json(F.trim(F.substring(message, F.instr(message, ":") + 1, F.length(message))))
    rest = F.to_json(F.map_filter(
        F.from_json(value, "map<string,variant>"), lambda k, v: ~k.isin("@message", "SM")))
    # Reopen the object for one more field: `{"a":1}` to `{"a":1,` and `{}` to `{`.
    opened = F.regexp_replace(F.regexp_replace(rest, r"^\{\}$", "{"), r"\}$", ",")
    joined = F.concat(opened, F.lit('"SM":'), F.to_json(inner), F.lit("}"))
    app = F.array_contains(F.json_object_keys(value), "appname")
    return F.coalesce(F.when(app, value).when(F.instr(message, ":") > 0, joined), value)


def needles(names: str | Sequence[str], field: str = "appname") -> list[str]:
    """The text that tags a line, one per name of a list or comma text."""
    names = names.split(",") if isinstance(names, str) else names
    return [f'{field}":"{name.strip()}"' for name in names]


def tagged(value: Column | str, names: str | Sequence[str], field: str = "appname") -> Column:
    """Whether a line carries any of the tags."""
    value = as_column(value)
    return functools.reduce(operator.or_, [value.contains(n) for n in needles(names, field)])


def split_by_tag(df: DataFrame, names: Sequence[str], field: str = "appname", value: str = "value") -> DataFrame:
    """(tag, pdate, value) rows: each line once per tag it carries, in a single pass over the input."""
    pairs = F.array(*[
        F.struct(F.lit(name.strip()).alias("tag"), F.lit(needle).alias("needle"))
        for name, needle in zip(names, needles(names, field))
    ])
    carried = F.filter(pairs, lambda p: F.col(value).contains(p["needle"]))
    lines = df.select(F.explode(carried).alias("t"), F.col(value).alias("line"))
    return lines.select(
        F.col("t.tag").alias("tag"),
        times.text_day(received_time("line")).alias("pdate"),
        unwrap_message("line").alias("value"),
    )


def route(df: DataFrame, names: str | Sequence[str], field: str = "appname", value: str = "value") -> DataFrame:
    """(pdate, value) rows of the lines that carry any of the tags."""
    return df.where(tagged(value, names, field)).select(
        times.text_day(received_time(value)).alias("pdate"), unwrap_message(value).alias("value"))


def normalize_time(
    df: DataFrame, column: str, on_error: str = "null", observation: Observation | str | None = None
) -> DataFrame:
    """Turn a time text column into timestamps; typed columns stay.

    An observation counts the rows, those without a readable time and those of which only the leading date
    is readable; a named one shows up in the progress of a stream.
    """
    if column not in df.columns:
        raise ValueError(f"no time column {column!r} among {df.columns}")
    if not isinstance(df.schema[column].dataType, StringType):
        return df
    if observation is None:
        return df.withColumn(column, times.parse_stamp(f"`{column}`", on_error))
    unreadable = F.count(F.when(F.col(f"`{column}`").isNull(), 1)).alias("unreadable_times")
    mark = "_day_only"
    while mark in df.columns:
        mark += "_"
    day_only = F.count(F.when(F.col(mark), 1)).alias("day_only_times")
    seen = df.withColumn(mark, times.is_day_only(f"`{column}`")).withColumn(column, times.parse_stamp(f"`{column}`")).observe(
        observation, unreadable, day_only, F.count(F.lit(1)).alias("rows")).drop(mark)
    return seen if on_error == "null" else seen.withColumn(
        column, F.coalesce(F.col(f"`{column}`"), F.current_timestamp()))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def escape_quotes(df: DataFrame) -> DataFrame:
    """Double the single quotes of text columns; other types stay."""
    return df.select([
        F.replace(F.col(f"`{f.name}`"), F.lit("'"), F.lit("''")).alias(f.name)
        if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows that are null in all columns."""
    return df.na.drop("all")


def table_rows(df: DataFrame) -> DataFrame:
    """What a keyed table stores of a frame: no `raw`, lower-case names, no empty rows."""
    return drop_empty_rows(lower_names(df.drop("raw")))
