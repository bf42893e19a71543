"""A stage of SQL statements over one input frame."""

from __future__ import annotations

import re
from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..functions import sql_names
from ..functions.times import relative_day
from ..operators.periods import is_marked, mark
from ..operators.shaping import needles, parse_value

SOURCE = "SOURCE_VIEW"
_VIEW = re.compile(
    r"create\s+(?:or\s+replace\s+)?temp(?:orary)?\s+view\s+(\w+)\s+as\s+(.*)", re.IGNORECASE | re.DOTALL)
_DEDUP = re.compile(r"dropduplicates\s+(.*)", re.IGNORECASE | re.DOTALL)
# The id function's argument never mattered; Spark's own takes none.
_UUID_ARGUMENT = re.compile(r"\buuid\(\s*[\w.`@]+\s*\)", re.IGNORECASE)


def _marked(df: DataFrame, parameters: Mapping) -> DataFrame:
    """Watermark the period column of a stream once it has been cut to its period."""
    column = parameters.get("timeStampField", "time_stamp")
    if not df.isStreaming or "aggregatePeriod" not in parameters or column not in df.columns or is_marked(df):
        return df
    return mark(df, column, parameters["aggregatePeriod"])


@contextmanager
def _sql_rules(spark: SparkSession, ansi: bool):
    """Analyse statements by ANSI rules or by the lenient ones older SQL texts were written for."""
    name = "spark.sql.ansi.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, str(ansi).lower())
    try:
        yield
    finally:
        spark.conf.set(name, before)


def sql_stage(
    spark: SparkSession, text: str, df: DataFrame | None = None, parameters: Mapping | None = None,
    run_day: str | None = None, ansi: bool = False,
) -> DataFrame | None:
    """Run `;`-separated statements; the last SELECT or view is the result.

    The input is the view `SOURCE_VIEW`. `CREATE VIEW v AS DropDuplicates a, b` removes duplicates
    from the frame or view made just before. `$date` stands for the `date` parameter in statements
    other than SELECT. With `aggregatePeriod` the period functions are those of that period. Without
    `ansi`, mixed types meet as text and a failed cast or division gives null.
    """
    with _sql_rules(spark, ansi):
        return _run(spark, text, df, parameters or {}, run_day)


def _run(spark: SparkSession, text: str, df: DataFrame | None, parameters: Mapping, run_day: str | None):
    if "aggregatePeriod" in parameters:
        sql_names.register_period(spark, parameters["aggregatePeriod"])
    for name, field in (("featureName", "featureName"), ("appName", "appname")):
        if name in parameters:
            sql_names.register_tag_filter(spark, needles(parameters[name], field))
            break
    if df is not None:
        df.createOrReplaceTempView(SOURCE)
    result = df
    for statement in (s.strip() for s in text.split(";")):
        if not statement:
            continue
        statement = _UUID_ARGUMENT.sub("uuid()", statement)
        if statement[:6].lower() == "select":
            result = spark.sql(statement)
            continue
        if "date" in parameters:
            statement = statement.replace("$date", relative_day(parameters["date"], run_day))
        view = _VIEW.fullmatch(statement)
        if view is None:
            made = spark.sql(statement)
            result = made if made.columns else result
            continue
        name, body = view.groups()
        dedup = _DEDUP.fullmatch(body)
        if dedup:
            if result is None:
                raise ValueError("DropDuplicates needs an input frame")
            result = _marked(result, parameters).dropDuplicates(["".join(c.split()) for c in dedup[1].split(",")])
        else:
            result = _marked(spark.sql(body), parameters)
        result.createOrReplaceTempView(name)
    if "schema" in parameters and result is not None and result.columns:
        result = parse_value(result, parameters["schema"])
    return result
