"""Identifiers and composite keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .times import as_column


def event_key(*parts: Column | str) -> Column:
    """Parts joined by `^`; null as soon as one part is null."""
    out = []
    for part in parts:
        out += [F.lit("^"), as_column(part).cast("string")]
    return F.concat(*out[1:])


def name_uuid(text: Column | str) -> Column:
    """Version 3 UUID of a text's bytes: equal text, equal id, so retries repeat it."""
    m = F.md5(as_column(text).cast("binary"))
    variant = F.conv(F.substring(m, 17, 1), 16, 10).cast("int") % 4
    return F.concat(
        F.substring(m, 1, 8), F.lit("-"),
        F.substring(m, 9, 4), F.lit("-3"),
        F.substring(m, 14, 3), F.lit("-"),
        F.substring(F.lit("89ab"), variant + 1, F.lit(1)),
        F.substring(m, 18, 3), F.lit("-"),
        F.substring(m, 21, 12),
    )


def given_id(dataid: Column | None) -> Column:
    """The column `dataid`, null where `with_repeatable_id` is to fill it."""
    return (F.lit(None).cast("string") if dataid is None else dataid).alias("dataid")


def with_repeatable_id(rows: DataFrame, dataid: Column | None) -> DataFrame:
    """`dataid` as given, or else named by the row's other columns: a retry repeats it, and equal rows share it."""
    if dataid is not None:
        return rows
    return rows.withColumn("dataid", name_uuid(F.to_json(F.struct(*[f"`{c}`" for c in rows.columns if c != "dataid"]))))


def random_uuid() -> Column:
    return F.expr("uuid()")


def file_name(path: Column | str | None = None) -> Column:
    """Last part of a path; of the row's input file when no path is given."""
    return F.substring_index(F.input_file_name() if path is None else as_column(path), "/", -1)


def percent(part: Column | str, whole: Column | str) -> Column:
    """`part / whole` as a whole percentage, cut off; null when it has no value."""
    return (F.try_divide(as_column(part), as_column(whole)) * 100).try_cast("int")
