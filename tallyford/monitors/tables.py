"""Table monitors: sums per organisation of one day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# Relations by default; result name and source column of sums and counts.
DATA_RELATIONS = ["activeUserRollUp", "callDuration", "callQuality", "fileUsed", "rtUser", "videoUsage"]
AGG_RELATIONS = ["activeUser", "callDuration", "callQuality", "fileUsed", "topUser", "messageSent"]
DATA_SUMS = {
    "call": "iscall", "message": "ismessage", "legduration": "legduration", "duration": "duration",
    "audio_is_good": "audio_is_good", "contentsize": "contentsize", "isfile": "isfile", "videotime": "videotime",
}
DATA_COUNTS = {"number_of_groups": "group"}
AGG_SUMS = {
    "usercountbyorg": "usercountbyorg", "onetoonecount": "onetoonecount", "spacecount": "spacecount",
    "successful_calls": "number_of_successful_calls", "minutes": "number_of_minutes",
    "bad_calls": "number_of_bad_calls", "total_calls": "number_of_total_calls", "files": "files",
    "filesize": "filesize", "message": "messages", "messages": "messages", "calls": "calls",
}
AGG_COUNTS = {"number_of_ua_category": "ua_category", "number_of_userid": "userid"}


def _sums(df: DataFrame, keys: Sequence[str], sums: dict, counts: dict) -> DataFrame:
    return df.groupBy(*keys).agg(
        *[F.sum(column).alias(name) for name, column in sums.items()],
        *[F.count(column).alias(name) for name, column in counts.items()])


def data_sums(
    facts: DataFrame, orgs: Sequence[str], day: str, region: str | None = None,
    relations: str | Sequence[str] = tuple(DATA_RELATIONS),
) -> DataFrame:
    """Sums of the fact table per relation, organisation and day, tagged with a region."""
    rows = common.of_relations(common.of_orgs(facts, orgs), relations).where(F.col("pdate") == day)
    totals = _sums(rows, ["relation_name", "orgid", "pdate"], DATA_SUMS, DATA_COUNTS)
    return totals.withColumn("region", F.lit(region).cast("string"))


def aggregate_sums(
    aggregates: DataFrame, orgs: Sequence[str], day: str, region: str | None = None,
    relations: str | Sequence[str] = tuple(AGG_RELATIONS),
) -> DataFrame:
    """Sums of the daily aggregates per relation, organisation and time, tagged with a region."""
    rows = common.of_relations(common.of_orgs(aggregates, orgs), relations).where(
        (F.col("period") == "daily") & (F.col("time_stamp") == F.lit(day).cast("timestamp")))
    totals = _sums(rows, ["relation_name", "orgid", "time_stamp"], AGG_SUMS, AGG_COUNTS)
    return totals.withColumn("region", F.lit(region).cast("string"))


def daily_duration(facts: DataFrame, orgs: Sequence[str], day: str, source: str = "bc") -> DataFrame:
    """Leg duration per organisation of one source."""
    rows = common.of_orgs(common.of_relations(facts, ["callDuration"]), orgs).where(
        (F.col("source") == source) & (F.col("pdate") == day))
    return _sums(rows, ["orgid", "pdate"], {"legduration": "legduration"}, {})


def daily_quality(facts: DataFrame, orgs: Sequence[str], day: str) -> DataFrame:
    """Duration and good audio calls per organisation."""
    rows = common.of_orgs(common.of_relations(facts, ["callQuality"]), orgs).where(F.col("pdate") == day)
    return _sums(rows, ["orgid", "pdate"], {"duration": "duration", "audio_is_good": "audio_is_good"}, {})


def daily_sums(facts: DataFrame, orgs: Sequence[str], day: str, source: str = "bc") -> DataFrame:
    """`daily_duration` and `daily_quality` in one pass: (kind, orgid, pdate, total, audio_is_good)."""
    is_duration = F.col("relation_name") == "callDuration"
    rows = common.of_orgs(common.of_relations(facts, ["callDuration", "callQuality"]), orgs).where(
        (F.col("pdate") == day) & (~is_duration | (F.col("source") == source)))
    kind = F.when(is_duration, "duration").otherwise("quality")
    return rows.groupBy(kind.alias("kind"), "orgid", "pdate").agg(
        F.sum(F.when(is_duration, F.col("legduration").cast("double")).otherwise(F.col("duration"))).alias("total"),
        F.sum(F.when(~is_duration, F.col("audio_is_good"))).alias("audio_is_good"))


def table_messages(rows: DataFrame, time: str) -> DataFrame:
    """Messages of `data_sums` (time `pdate`) and `aggregate_sums` (time `time_stamp`)."""
    measures = [c for c in rows.columns if c not in ("relation_name", "orgid", "region", time)]
    data = F.struct("orgid", *measures, "region", F.col(time).alias("reportDate"))
    return rows.select(*common.message(F.struct(F.col("relation_name").alias("pipeLine"), data.alias("data"))))


def daily_messages(rows: DataFrame, pipeline: str) -> DataFrame:
    """Messages of `daily_duration` (`BCDuration`) and `daily_quality` (`BCQuality`)."""
    measures = [c for c in rows.columns if c not in ("orgid", "pdate")]
    data = F.struct("orgid", *measures, F.col("pdate").alias("reportDate"))
    return rows.select(*common.message(F.struct(F.lit(pipeline).alias("pipeLine"), data.alias("data"))))
