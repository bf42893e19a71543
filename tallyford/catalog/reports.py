"""The reports, on event frames derived from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ids import name_uuid
from ..reports import calls, content, devices, keys, licences, usage
from . import derive
from .registry import query, table, with_text_time

_TEXT = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
_DAY = "date_trunc('day', time_stamp)"
_WEEK = "CAST(time_stamp::DATE - dayofweek(time_stamp)::INT AS TIMESTAMP)"
_MONTH = "date_trunc('month', time_stamp)"


def _count_sql(cte: str, source: str, start: str, period: str, key_columns: str, key: str, measure: str, relation: str) -> str:
    return f"""{cte}
SELECT t || '^' || {key} || '^{relation}^{period}' AS "eventKey", t AS time_stamp, {key_columns}, {measure},
  '{period}' AS period, '{relation}' AS relation_name
FROM (SELECT *, strftime({start}, '%Y-%m-%d %H:%M:%S') AS t FROM {source}) GROUP BY t, {key_columns}"""


def active_facts(spark, sf):
    events = derive.conversation_events(table(spark, sf, "events"))
    return usage.active_users(
        events, derive.excluded(spark), derive.testers(spark), derive.agents(spark),
        room_device_prefix=derive.ROOM_PREFIX)


@query("active_users", f"""{derive.CONVERSATION_SQL}
SELECT * REPLACE ({_TEXT.format('time_stamp')} AS time_stamp) FROM fact""")
def active_users(spark, sf):
    return with_text_time(active_facts(spark, sf))


@query("active_user_count", _count_sql(
    derive.CONVERSATION_SQL, "fact", _DAY, "daily", 'orgId', 'orgId', 'count(DISTINCT userId) AS "userCountByOrg"',
    "activeUser"))
def active_user_count(spark, sf):
    return with_text_time(usage.active_user_count(active_facts(spark, sf), "daily"))


@query("one_to_one_count", _count_sql(
    derive.CONVERSATION_SQL, "fact", _WEEK, "weekly", 'orgId', 'orgId', 'count(DISTINCT oneToOne) AS "oneToOneCount"',
    "activeUser"))
def one_to_one_count(spark, sf):
    return with_text_time(usage.one_to_one_count(active_facts(spark, sf), "weekly"))


@query("space_count", _count_sql(
    derive.CONVERSATION_SQL, "fact", _MONTH, "monthly", 'orgId', 'orgId', 'count(DISTINCT "group") AS "spaceCount"',
    "activeUser"))
def space_count(spark, sf):
    return with_text_time(usage.space_count(active_facts(spark, sf), "monthly"))


_END = "date_trunc('day', time_stamp) + INTERVAL 1 DAY - INTERVAL 1 SECOND"


@query("active_user_rollup", f"""{derive.CONVERSATION_SQL}
SELECT {_TEXT.format('t')} AS time_stamp, strftime(t, '%Y-%m-%d') AS pdate,
  strftime(t, '%Y-%m-%d') || '^' || orgId || '^' || userId AS dataid, orgId, userId,
  sum(isMessage)::BIGINT AS "isMessage", sum(isCall)::BIGINT AS "isCall", 'activeUserRollUp' AS relation_name
FROM (SELECT *, {_END} AS t FROM fact) GROUP BY t, orgId, userId""")
def active_user_rollup(spark, sf):
    return with_text_time(usage.user_day_rollup(active_facts(spark, sf)))


@query("room_users", f"""{derive.CONVERSATION_SQL}
SELECT DISTINCT {_TEXT.format('t')} AS time_stamp, strftime(t, '%Y-%m-%d') AS pdate,
  strftime(t, '%Y-%m-%d') || '^' || orgId || '^rtUser^' || coalesce(oneToOne, '0') || '^' || coalesce("group", '0')
    AS dataid, orgId, userId, oneToOne, "group", 'rtUser' AS relation_name
FROM (SELECT *, {_END} AS t FROM fact)""")
def room_users(spark, sf):
    return with_text_time(usage.room_users(active_facts(spark, sf)))


@query("top_users", f"""{derive.CONVERSATION_SQL}, u AS (
  SELECT strftime({_WEEK}, '%Y-%m-%d %H:%M:%S') AS t, orgId, userId, sum(isMessage)::BIGINT AS messages,
    sum(isCall)::BIGINT AS calls FROM fact GROUP BY ALL)
SELECT t || '^' || orgId || '^' || userId || '^topUser^weekly' AS "eventKey", t AS time_stamp, orgId, userId, messages,
  calls, 'weekly' AS period, 'topUser' AS relation_name
FROM (SELECT *, dense_rank() OVER (PARTITION BY orgId ORDER BY messages + calls DESC) AS r FROM u) WHERE r <= 2""")
def top_users(spark, sf):
    return with_text_time(usage.top_users(active_facts(spark, sf), "weekly", 2))


def legs(spark, sf):
    events = derive.call_legs(table(spark, sf, "lineitem"))
    return calls.call_duration(events, derive.excluded(spark), name_uuid("call_id"))


@query("call_duration", f"""{derive.LEGS_SQL}
SELECT * REPLACE ({_TEXT.format('time_stamp')} AS time_stamp) FROM leg""")
def call_duration(spark, sf):
    return with_text_time(legs(spark, sf).drop("dataid", "raw"))


@query("call_minutes", _count_sql(
    derive.LEGS_SQL, "counted", _MONTH, "monthly", "orgId, ep1", "orgId || '^' || ep1",
    "round(sum(legDuration) / 60)::BIGINT AS number_of_minutes", "callDuration"))
def call_minutes(spark, sf):
    return with_text_time(calls.call_minutes(legs(spark, sf), derive.endpoints(spark), "monthly"))


@query("total_calls", _count_sql(
    derive.LEGS_SQL, "counted", _WEEK, "weekly", "orgId, ep1", "orgId || '^' || ep1",
    "count(DISTINCT call_id) AS number_of_successful_calls", "callDuration"))
def total_calls(spark, sf):
    return with_text_time(calls.total_calls(legs(spark, sf), derive.endpoints(spark), "weekly"))


def quality_facts(spark, sf):
    events = derive.quality_events(table(spark, sf, "lineitem"))
    return calls.call_quality(events, derive.excluded(spark), name_uuid("call_id"))


@query("call_quality", f"""{derive.QUALITY_SQL}
SELECT * REPLACE ({_TEXT.format('time_stamp')} AS time_stamp, round(audio_jitter, 6) AS audio_jitter,
    round(video_jitter, 6) AS video_jitter), '1.0' AS "uaVersion", 'Spark' AS source, 'callQuality' AS relation_name
FROM quality""")
def call_quality(spark, sf):
    rows = quality_facts(spark, sf).drop("dataid", "raw")
    return with_text_time(rows.withColumns({
        name: F.round(name, 6) for name in ("audio_jitter", "video_jitter")}))


_BAD = "CASE WHEN audio_jitter > 150 OR audio_rtt > 400 OR audio_packetloss > 5 THEN 1 ELSE 0 END"


@query("bad_calls", _count_sql(
    derive.QUALITY_SQL, f"(SELECT DISTINCT {_DAY} AS time_stamp, orgId, call_id, {_BAD} AS bad FROM quality)",
    _DAY, "daily", "orgId", "orgId", "sum(bad)::BIGINT AS number_of_bad_calls", "callQuality"))
def bad_calls(spark, sf):
    return with_text_time(calls.bad_calls(quality_facts(spark, sf), "daily"))


@query("all_calls", _count_sql(
    derive.QUALITY_SQL, "quality", _DAY, "daily", "orgId", "orgId",
    "count(DISTINCT call_id) AS number_of_total_calls", "callQuality"))
def all_calls(spark, sf):
    return with_text_time(calls.all_calls(quality_facts(spark, sf), "daily"))


@query("top_poor_quality", f"""{derive.QUALITY_SQL}, u AS (
  SELECT strftime({_MONTH}, '%Y-%m-%d %H:%M:%S') AS t, orgId, userId,
    sum(CASE WHEN audio_is_good = 0 AND video_is_good = 0 THEN 1 ELSE 0 END)::BIGINT AS number_of_bad_calls
  FROM quality GROUP BY ALL)
SELECT t || '^' || orgId || '^' || userId || '^topPoorQuality^monthly' AS "eventKey", t AS time_stamp, orgId, userId,
  number_of_bad_calls, 'monthly' AS period, 'topPoorQuality' AS relation_name
FROM (SELECT *, dense_rank() OVER (PARTITION BY orgId ORDER BY number_of_bad_calls DESC) AS r FROM u
  WHERE number_of_bad_calls > 0) WHERE r <= 2""")
def top_poor_quality(spark, sf):
    return with_text_time(calls.top_poor_quality(quality_facts(spark, sf), "monthly", 2))


def shares(spark, sf):
    orgs = derive.member_list(spark, ["src3"], "org_id")
    return content.files_used(derive.share_events(table(spark, sf, "documents")), orgs)


@query("files_used", f"{derive.SHARES_SQL} SELECT * FROM used")
def files_used(spark, sf):
    return with_text_time(shares(spark, sf).drop("raw"))


@query("file_count", f"""{derive.SHARES_SQL}, once AS (
  SELECT time_stamp, dataid, orgId, max(isFile) AS isFile, contentSize FROM used GROUP BY ALL)
SELECT t || '^' || orgId || '^fileUsed^weekly' AS "eventKey", t AS time_stamp, orgId, sum(isFile)::BIGINT AS files,
  sum(contentSize)::BIGINT AS "fileSize", 'weekly' AS period, 'fileUsed' AS relation_name
FROM (SELECT *, strftime(time_stamp::DATE - dayofweek(time_stamp::DATE)::INT, '%Y-%m-%d 00:00:00') AS t FROM once)
GROUP BY t, orgId""")
def file_count(spark, sf):
    return with_text_time(content.file_count(shares(spark, sf), "weekly"))


def endpoints(spark, sf):
    events = derive.device_events(table(spark, sf, "orders"))
    return devices.registered_endpoints(events, derive.excluded(spark), name_uuid("deviceId"))


@query("registered_endpoints", f"""{derive.DEVICES_SQL}
SELECT * REPLACE ({_TEXT.format('time_stamp')} AS time_stamp) FROM device""")
def registered_endpoints(spark, sf):
    return with_text_time(endpoints(spark, sf).drop("dataid", "raw"))


@query("endpoint_count", _count_sql(
    derive.DEVICES_SQL, "device", _MONTH, "monthly", "orgId, model", "orgId || '^' || model",
    'count(DISTINCT deviceId) AS "registeredEndpointCount"', "registeredEndpoint"))
def endpoint_count(spark, sf):
    return with_text_time(devices.endpoint_count(endpoints(spark, sf), "monthly"))


_LICENCES = """
WITH p AS (SELECT *, p_size % 3 = 0 AS auto, p_partkey % 3 AS action,
    DATE '2024-01-01' + CAST(p_partkey % 30 AS INT) AS d FROM part),
kept AS (SELECT *, unnest(string_split(p_name, ' ')) AS word FROM p
  WHERE (p_size % 2 = 0 AND (action = 0 OR (auto AND action = 1)))
    OR (p_size % 2 = 1 AND (p_partkey % 2 = 0 OR auto)))
SELECT strftime(d, '%Y-%m-%d 00:00:00') AS time_stamp, strftime(d, '%Y-%m-%d') AS pdate, 'license' AS relation_name,
  word AS licenses, p_brand AS adminid, p_type AS onboardmethod, CASE WHEN auto THEN 'AUTO' ELSE 'MANUAL' END
  AS licensesassign, CASE WHEN p_partkey % 5 = 0 THEN 'SENT' ELSE 'SUCCESS' END AS status,
  CAST(NULL AS VARCHAR) AS errormessage,
  CASE WHEN p_partkey % 4 = 0 THEN 'i' || p_partkey ELSE 'u' || p_partkey END AS userid,
  'org' || (p_size % 10) AS orgid, CAST(p_partkey AS VARCHAR) AS raw
FROM kept"""


@query("auto_licences", _LICENCES)
def auto_licences(spark, sf):
    rows = licences.auto_licences(derive.provisioning_events(table(spark, sf, "part")))
    return with_text_time(rows.drop("dataid"))


@query("keys_to_delete", f"""{derive.SHARES_SQL} SELECT pdate, relation_name, time_stamp, dataid FROM used""")
def keys_to_delete(spark, sf):
    return with_text_time(keys.keys_to_delete(shares(spark, sf)))
