"""Call legs, call counts and call quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.histograms import average_of_minima
from ..functions.ids import event_key, given_id, with_repeatable_id
from ..functions.times import iso_day
from ..operators import lookups, periods, ranking
from . import vocabulary as v
from .usage import first_known, flag


def stamp(column: Column | str) -> Column:
    """Event time with milliseconds; null when unreadable."""
    return F.try_to_timestamp(F.col(column) if isinstance(column, str) else column, F.lit(v.STAMP))


def call_duration(events: DataFrame, excluded_orgs: DataFrame, dataid: Column | None = None) -> DataFrame:
    """Ended call legs. `dataid` names the row's columns unless an id is given."""
    fields = F.col("`@fields`")
    legs = events.where(
        (F.col("_appname") == v.CALL_APP) & (F.col("SM.uaType") != v.BRIDGE_AGENT)
        & (F.col("SM.env").isNull() | (F.col("SM.env") != "TEST"))
        & (F.col("SM.metricType") == "CALL_LEG") & (F.col("SM.callType") == v.CALL_ENDED)
    ).select(
        stamp("`@timestamp`").alias("time_stamp"),
        first_known("SM.orgId", "SM.participant.orgId").alias("orgId"),
        first_known("`@fields`.USER_ID", "SM.actor.id", "SM.participant.userId", "SM.userId", "SM.uid",
                    "SM.onBoardedUser").alias("userId"),
        fields["uaVersion"].alias("uaVersion"),
        F.col("SM.uaType").alias("uaType"),
        F.col("SM.legDuration").alias("legDuration"),
        F.lit(v.SOURCE).alias("SOURCE"),
        F.col("SM.deviceType").alias("deviceType"),
        event_key(fields["LOCUS_ID"], fields["locusStartTime"]).alias("call_id"),
        F.lit("callDuration").alias("relation_name"),
        "raw",
    ).where(F.col("orgId") != v.UNKNOWN)
    legs = lookups.drop_members(legs, excluded_orgs, "orgId")
    facts = legs.select(
        "time_stamp", iso_day("time_stamp").alias("pdate"),
        given_id(dataid),
        "orgId", "userId", "uaVersion", "uaType", "legDuration", "SOURCE", "deviceType", "call_id", "relation_name",
        "raw")
    return with_repeatable_id(facts, dataid)


def _counted_legs(legs: DataFrame) -> DataFrame:
    return legs.where(F.col("deviceType").isNull() | (F.col("deviceType") != v.SHARE_DEVICE))


def call_minutes(legs: DataFrame, endpoints: DataFrame, period: str) -> DataFrame:
    """Call minutes per organisation and endpoint class; sharing devices do not count."""
    rows = lookups.endpoint_class(_counted_legs(legs), endpoints, "deviceType", "uaType")
    minutes = F.round(F.sum("legDuration") / 60).cast("bigint")
    rows = rows.select("time_stamp", "orgId", "ep1", "legDuration")
    return periods.sums(rows, period, ["orgId", "ep1"], {"number_of_minutes": minutes}, "callDuration")


def total_calls(legs: DataFrame, endpoints: DataFrame, period: str) -> DataFrame:
    """Distinct calls per organisation and endpoint class; sharing devices do not count."""
    rows = lookups.endpoint_class(_counted_legs(legs), endpoints, "deviceType", "uaType")
    return periods.distinct_count(
        rows, period, ["orgId", "ep1"], "call_id", "number_of_successful_calls", "callDuration")


def call_quality(events: DataFrame, excluded_orgs: DataFrame, dataid: Column | None = None) -> DataFrame:
    """Media quality of desktop calls over ten seconds, from the histograms of their end events."""
    key, value = F.col("SM_C.key"), F.col("SM_C.value")
    stats = value["mediaStatistics"]["stats"]
    kinds = {"audio": v.AUDIO_END, "video": v.VIDEO_END}
    measures = {"jitter": "jitter", "rtt": "rtt", "packetloss": "lossRatio"}
    averages = [
        F.when(key == end, average_of_minima(stats[source])).alias(f"{kind}_{name}")
        for name, source in measures.items() for kind, end in kinds.items()
    ]
    calls = events.where(
        (F.col("appname") == v.METRICS_APP) & (value["clientCallDuration"] > v.MIN_CALL_MS)
        & key.isin(v.AUDIO_END, v.VIDEO_END) & F.col("uaType").isin(v.DESKTOP_AGENTS)
    ).select(
        stamp("timeRcvd").alias("time_stamp"),
        first_known("orgId").alias("orgId"),
        first_known("userId").alias("userId"),
        value["clientCallDuration"].alias("duration"),
        key.alias("mediaType"),
        event_key(value["locusId"], value["locusTimestamp"]).alias("call_id"),
        *averages,
        "uaVersion", "uaType", F.lit(v.SOURCE).alias("source"),
        F.col("SM_C.sessionId").alias("confId"),
        value["correlationId"].alias("meetingId"),
        "raw",
    ).where(F.col("orgId") != v.UNKNOWN)
    calls = lookups.drop_members(calls, excluded_orgs, "orgId")
    media = F.col("mediaType")
    good_audio = (
        (media == v.AUDIO_END) & (F.col("audio_jitter") <= v.GOOD_JITTER) & (F.col("audio_rtt") <= v.GOOD_RTT)
        & (F.col("audio_packetloss") <= v.GOOD_LOSS)
    )
    facts = calls.select(
        "time_stamp", iso_day("time_stamp").alias("pdate"),
        given_id(dataid),
        "orgId", "userId", "duration", "mediaType", "call_id",
        "audio_jitter", "video_jitter", "audio_rtt", "video_rtt", "audio_packetloss", "video_packetloss",
        "uaVersion", "uaType", "source", "confId", "meetingId",
        flag(good_audio).alias("audio_is_good"), flag(media == v.VIDEO_END).alias("video_is_good"),
        F.lit("callQuality").alias("relation_name"), "raw")
    return with_repeatable_id(facts, dataid)


def bad_calls(quality: DataFrame, period: str) -> DataFrame:
    """Distinct calls per organisation with a bad audio measure."""
    bad = flag((F.col("audio_jitter") > v.GOOD_JITTER) | (F.col("audio_rtt") > v.GOOD_RTT)
               | (F.col("audio_packetloss") > v.GOOD_LOSS)).alias("quality_is_bad")
    rows = periods.cut(quality, period, ["orgId", "call_id", bad]).dropDuplicates(
        ["time_stamp", "orgId", "call_id", "quality_is_bad"])
    counts = rows.groupBy("time_stamp", "orgId").agg(F.sum("quality_is_bad").alias("number_of_bad_calls"))
    return periods.labelled(counts, period, "callQuality", ["orgId"], ["number_of_bad_calls"])


def all_calls(quality: DataFrame, period: str) -> DataFrame:
    """Distinct calls per organisation."""
    return periods.distinct_count(quality, period, ["orgId"], "call_id", "number_of_total_calls", "callQuality")


def top_poor_quality(quality: DataFrame, period: str, k: int = v.TOP_USERS) -> DataFrame:
    """The users of each organisation with the most bad calls, ties included."""
    bad = flag((F.col("audio_is_good") == 0) & (F.col("video_is_good") == 0))
    rows = quality.select("time_stamp", "orgId", "userId", bad.alias("quality_is_bad"))
    per_user = periods.sums(
        rows, period, ["orgId", "userId"], {"number_of_bad_calls": F.sum("quality_is_bad")}, "topPoorQuality")
    some = per_user.where(F.col("number_of_bad_calls") > 0)
    return ranking.top_ranked(some, ["orgId"], F.col("number_of_bad_calls"), k).select(per_user.columns)
