"""Licence monitor: users who got a licence on a day against the average of business days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import business_day
from . import common

# Fixed values.
HISTORY_DAYS = 33
SUCCESS = "SUCCESS"


def run(licences: DataFrame, orgs: Sequence[str], day: str) -> DataFrame:
    """One pass: distinct users per organisation and day, then day and history side by side.

    Organisations without licences on the day, or without history, do not appear.
    """
    past = F.col("pdate").isin(common.business_days_before(day, HISTORY_DAYS))
    today = F.col("pdate") == day
    rows = common.of_orgs(common.of_relations(licences, ["license"]), orgs).where(
        (F.col("status") == SUCCESS) & (past | today))
    per_day = rows.groupBy("orgid", "pdate").agg(F.count_distinct("userid").alias("_users"))
    per_org = per_day.groupBy("orgid").agg(
        F.max(F.when(today, F.col("_users"))).alias("licenseCount"),
        F.avg(F.when(past, F.col("_users"))).cast("int").alias("avg"))
    return per_org.where(F.col("licenseCount").isNotNull() & F.col("avg").isNotNull()).select(
        "orgid", F.lit(day).alias("pdate"), "licenseCount", F.lit(business_day(day)).alias("isBusinessDay"), "avg")


def messages(rows: DataFrame) -> DataFrame:
    data = F.struct(F.col("pdate").alias("date"), "licenseCount", "isBusinessDay", "orgid", "avg")
    return rows.select(*common.message(F.struct(
        F.lit("license").alias("pipeLine"), F.lit("anomalyDetection").alias("phase"),
        common.start_of().alias("sendTime"), data.alias("data"))))
