"""Registered room devices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import given_id, with_repeatable_id
from ..functions.times import iso_day
from ..operators import lookups, periods
from . import vocabulary as v
from .calls import stamp
from .usage import first_known


def registered_endpoints(events: DataFrame, excluded_orgs: DataFrame, dataid: Column | None = None) -> DataFrame:
    """Room devices that reported in, with normalised model names."""
    model = F.col("SM_C.value.model")
    renamed = model
    for name, shown in v.MODEL_NAMES.items():
        renamed = F.when(model == name, shown).otherwise(renamed)
    rows = events.where(
        (F.col("appname") == v.METRICS_APP) & F.col("uaType").isin(v.ROOM_AGENTS)
        & F.col("SM_C.key").isin(v.SYSTEM_INFO_KEYS)
    ).select(
        stamp("timeRcvd").alias("time_stamp"),
        first_known("orgId").alias("orgId"),
        F.col("SM_C.value.deviceIdentifier").alias("deviceId"),
        F.coalesce(renamed, F.lit(v.UNKNOWN)).alias("model"),
        "raw",
    ).where(F.col("orgId") != v.UNKNOWN)
    rows = lookups.drop_members(rows, excluded_orgs, "orgId")
    facts = rows.select(
        "time_stamp", iso_day("time_stamp").alias("pdate"),
        given_id(dataid),
        "orgId", F.lit("NA").alias("userId"), "deviceId", "model", F.lit("registeredEndpoint").alias("relation_name"),
        "raw")
    return with_repeatable_id(facts, dataid)


def endpoint_count(facts: DataFrame, period: str) -> DataFrame:
    """Distinct devices per organisation and model."""
    return periods.distinct_count(
        facts, period, ["orgId", "model"], "deviceId", "registeredEndpointCount", "registeredEndpoint")
