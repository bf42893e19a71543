"""Active users: event classification, counts per period, roll-ups and top users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import event_key
from ..functions.times import end_of_day, iso_day
from ..operators import lookups, periods, ranking
from . import vocabulary as v


def first_known(*names: str) -> Column:
    """The first of the columns that is set, else `unknown`."""
    return F.coalesce(*[F.col(n) for n in names], F.lit(v.UNKNOWN))


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("bigint")


def _message_events() -> Column:
    verb, kind, target = F.col("SM.verb"), F.col("SM.object.objectType"), F.col("SM.target.objectType")
    activity = (
        ((verb == "acknowledge") & (kind == "activity"))
        | ((verb == "post") & (kind == "comment"))
        | ((verb == "share") & (kind == "content"))
        | ((verb == "create") & kind.isin("conversation", "team"))
        | ((verb == "add") & (kind == "person") & (target == "conversation"))
    )
    return (F.col("appname") == v.MESSAGE_APP) & ~F.col("SM.uaType").isin(v.IGNORED_AGENTS) & activity


def _call_events(room_device_prefix: str) -> Column:
    metric, device = F.col("SM.metricType"), F.col("SM.deviceType")
    ended = F.col("SM.callType") == v.CALL_ENDED
    person = (
        (metric == "PARTICIPANT") & ended & F.col("SM.squared")
        & ~F.col("SM.locusType").isin(v.NOT_COUNTED_LOCUS_TYPES)
    )
    counted_device = ~device.isin(v.NOT_COUNTED_DEVICES) & ~F.startswith(device, F.lit(room_device_prefix))
    meeting = (metric == "DEVICE") & F.col("SM.locusType").isin(v.MEETING_TYPES) & ended & counted_device
    return (F.col("appname") == v.CALL_APP) & (person | meeting)


def active_users(
    events: DataFrame, excluded_orgs: DataFrame, test_users: DataFrame, agents: DataFrame,
    tracking_id: str = "trackingId", *, room_device_prefix: str,
) -> DataFrame:
    """Classify message and call events per user; excluded organisations and test users drop out.

    `tracking_id` names the column with the event's id; `room_device_prefix` is the device type
    prefix of room systems, whose meeting events do not count.
    """
    if not room_device_prefix:
        raise ValueError("room_device_prefix must not be empty")
    one_to_one = F.col("SM.convOneOnOne")
    team = F.col("teamId").isNotNull()
    group = ~team & ~one_to_one
    room, verb, kind = F.col("SM.target.id"), F.col("SM.verb"), F.col("SM.object.objectType")
    user = F.col("userId")
    facts = events.where(_message_events() | _call_events(room_device_prefix)).select(
        F.col("timeRcvd").alias("time_stamp"),
        F.col(f"`{tracking_id}`").alias("dataid"),
        first_known("ORG_ID", "orgId", "SM.actor.orgId", "SM.participant.orgId", "SM.orgId").alias("orgId"),
        first_known("userId", "USER_ID", "SM.actor.id", "SM.participant.userId", "SM.userId", "SM.uid",
                    "SM.onBoardedUser").alias("userId"),
        flag((verb == "post") & (kind == "comment")).alias("isMessage"),
        flag((F.col("SM.metricType") == "PARTICIPANT") & (F.col("SM.callType") == v.CALL_ENDED)).alias("isCall"),
        flag((verb == "create") & kind.isin("team", "conversation")).alias("isCreate"),
        one_to_one.alias("_one"), group.alias("_group"), team.alias("_team"), room.alias("_room"),
        "appname",
        F.col("SM.locusType").alias("locustype"),
        F.when(F.col("appname") == v.MESSAGE_APP, F.concat_ws("_", verb, kind)).otherwise("call").alias("activity"),
        F.coalesce("SM.uaType", "uaType").alias("uaType"),
    )
    facts = facts.where((F.col("orgId") != v.UNKNOWN) & F.col("dataid").isNotNull())
    facts = lookups.drop_members(facts, excluded_orgs, "orgId")
    facts = lookups.drop_members(facts, test_users, "userId")
    facts = lookups.agent_category(facts, agents, "uaType")
    return facts.select(
        "time_stamp", iso_day("time_stamp").alias("pdate"), "dataid", "orgId", "userId",
        "isMessage", "isCall", "isCreate",
        F.when(F.col("_one") | F.col("_group") | F.col("_team"), user).alias("rtUser"),
        F.when(F.col("_one"), user).alias("oneToOneUser"),
        F.when(F.col("_group"), user).alias("groupUser"),
        F.when(F.col("_team"), user).alias("teamUser"),
        F.when(F.col("_one"), F.col("_room")).alias("oneToOne"),
        F.when(F.col("_group"), F.col("_room")).alias("group"),
        F.when(F.col("_team"), F.col("_room")).alias("team"),
        F.lit("activeUser").alias("relation_name"),
        "appname", "locustype", "activity", "uaType", "ua_category",
    )


def active_user_count(facts: DataFrame, period: str) -> DataFrame:
    return periods.distinct_count(facts, period, ["orgId"], "userId", "userCountByOrg", "activeUser")


def one_to_one_count(facts: DataFrame, period: str) -> DataFrame:
    return periods.distinct_count(facts, period, ["orgId"], "oneToOne", "oneToOneCount", "activeUser")


def space_count(facts: DataFrame, period: str) -> DataFrame:
    return periods.distinct_count(facts, period, ["orgId"], "group", "spaceCount", "activeUser")


def user_day_rollup(facts: DataFrame) -> DataFrame:
    """Messages and calls per user and end of day."""
    days = facts.select(end_of_day("time_stamp").alias("time_stamp"), "orgId", "userId", "isMessage", "isCall")
    sums = periods.mark(days, "time_stamp", "daily").groupBy("orgId", "userId", "time_stamp").agg(
        F.sum("isMessage").alias("isMessage"), F.sum("isCall").alias("isCall"))
    day = iso_day("time_stamp")
    return sums.select(
        "time_stamp", day.alias("pdate"), event_key(day, "orgId", "userId").alias("dataid"), "orgId", "userId",
        "isMessage", "isCall", F.lit("activeUserRollUp").alias("relation_name"))


def room_users(facts: DataFrame) -> DataFrame:
    """The distinct rooms each user was active in, per day."""
    keys = ["time_stamp", "orgId", "userId", "oneToOne", "group"]
    days = facts.select(end_of_day("time_stamp").alias("time_stamp"), *keys[1:])
    rows = periods.mark(days, "time_stamp", "daily").dropDuplicates(keys)
    day = iso_day("time_stamp")
    room_or_0 = [F.coalesce(F.col(c), F.lit("0")) for c in ("oneToOne", "group")]
    return rows.select(
        "time_stamp", day.alias("pdate"), event_key(day, "orgId", F.lit("rtUser"), *room_or_0).alias("dataid"),
        *keys[1:], F.lit("rtUser").alias("relation_name"))


def top_users(facts: DataFrame, period: str, k: int = v.TOP_USERS) -> DataFrame:
    """The most active users of each organisation, ties included; ranks span the periods of the input."""
    measures = {"messages": F.sum("isMessage"), "calls": F.sum("isCall")}
    rows = facts.select("time_stamp", "orgId", "userId", "isMessage", "isCall")
    per_user = periods.sums(rows, period, ["orgId", "userId"], measures, "topUser")
    return ranking.top_ranked(per_user, ["orgId"], F.col("messages") + F.col("calls"), k).select(per_user.columns)
