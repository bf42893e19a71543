"""Shared files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import event_key
from ..functions.times import iso_day
from ..operators import lookups, periods
from . import vocabulary as v
from .calls import stamp
from .usage import first_known, flag


def files_used(events: DataFrame, excluded_orgs: DataFrame) -> DataFrame:
    """Share events with file flag and size."""
    shares = events.where((F.col("_appname") == v.MESSAGE_APP) & (F.col("SM.verb") == "share")).select(
        stamp("`@timestamp`").alias("time_stamp"),
        first_known("orgId", "SM.actor.orgId", "SM.participant.orgId", "SM.orgId").alias("orgId"),
        first_known("userId", "`@fields`.USER_ID", "SM.actor.id", "SM.participant.userId", "SM.userId", "SM.uid",
                    "SM.onBoardedUser").alias("userId"),
        flag(F.col("SM.object.objectType") == "content").alias("isFile"),
        F.col("SM.object.contentSize").alias("contentSize"),
        "raw",
    ).where(F.col("orgId") != v.UNKNOWN)
    shares = lookups.drop_members(shares, excluded_orgs, "orgId")
    dataid = event_key(F.lit("fileUsed"), "time_stamp", "orgId", "userId", "contentSize")
    return shares.select(
        "time_stamp", iso_day("time_stamp").alias("pdate"), dataid.alias("dataid"), "orgId", "userId", "isFile",
        "contentSize", F.lit("fileUsed").alias("relation_name"), "raw")


def file_count(facts: DataFrame, period: str) -> DataFrame:
    """Files and bytes per organisation; an event seen twice counts once, as a file if any copy is one."""
    rows = facts.select("time_stamp", F.col("time_stamp").alias("_at"), "dataid", "orgId", "isFile", "contentSize")
    once = periods.cut(rows, period, ["_at", "dataid", "orgId", "isFile", "contentSize"]).groupBy(
        "time_stamp", "_at", "dataid", "orgId", "contentSize").agg(F.max("isFile").alias("isFile"))
    totals = once.groupBy("time_stamp", "orgId").agg(
        F.sum("isFile").alias("files"), F.sum("contentSize").alias("fileSize"))
    return periods.labelled(totals, period, "fileUsed", ["orgId"], ["files", "fileSize"])
