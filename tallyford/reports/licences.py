"""Licence provisioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import given_id, with_repeatable_id
from ..functions.times import iso_day
from .calls import stamp


def auto_licences(events: DataFrame, dataid: Column | None = None) -> DataFrame:
    """One row per licence of a provisioning or invite event."""
    sm = F.col("SM")
    auto = sm["autoTemplate"] == "true"
    provision = (sm["className"] == "ProvisioningMetricEvent") & (
        (sm["provAction"] == "ADD") | (auto & (sm["provAction"] == "PATCH")))
    invite = (sm["className"] == "InviteMetricEvent") & ((sm["inviteType"] == "ADMIN_INVITE") | auto)
    time = stamp("`@timestamp`")
    rows = events.where(provision | invite).select(
        time.alias("time_stamp"), F.explode(sm["licenses"]).alias("_licence"), "SM", "raw")
    facts = rows.select(
        "time_stamp",
        iso_day("time_stamp").alias("pdate"),
        given_id(dataid),
        F.lit("license").alias("relation_name"),
        F.substring_index("_licence", "_", 1).alias("licenses"),
        sm["adminId"].alias("adminid"),
        sm["onboardMethod"].alias("onboardmethod"),
        F.when(auto, "AUTO").otherwise("MANUAL").alias("licensesassign"),
        F.coalesce(sm["provStatus"], sm["inviteStatus"]).alias("status"),
        sm["errTxt"].alias("errormessage"),
        F.coalesce(sm["inviteeID"], sm["userId"]).alias("userid"),
        sm["orgId"].alias("orgid"),
        "raw")
    return with_repeatable_id(facts, dataid)
