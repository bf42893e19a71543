"""Event frames in the shapes the reports read, derived from the test tables row by row.

Each `*_SQL` text derives the same rows in DuckDB, flat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookups import mapping_table, member_list

STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
AGENTS = {"sparkmac": "DESKTOP", "Firefox": "WEB", "wx2-android": "MOBILE"}
ENDPOINTS = {"DESKTOP|sparkmac": "Desktop", "WEB|Chrome": "Web", "|sparkmac": "Desktop"}
EXCLUDED, TESTERS = ["org3"], ["u5"]
ROOM_PREFIX = "ROOM"


def agents(spark):
    return mapping_table(spark, AGENTS)


def endpoints(spark):
    return mapping_table(spark, ENDPOINTS)


def excluded(spark):
    return member_list(spark, EXCLUDED, "org_id")


def testers(spark):
    return member_list(spark, TESTERS, "user")


def conversation_events(events: DataFrame) -> DataFrame:
    """Message events from four event types, call events from the fifth."""
    return events.select("*", F.inline(F.array(F.from_json("props", "k INT")))).selectExpr(
        "CASE WHEN event_type = 'error' THEN 'locus' ELSE 'conv' END AS appname",
        "ts AS timeRcvd",
        "CASE WHEN event_id % 50 <> 0 THEN concat('t', event_id) END AS trackingId",
        "CASE WHEN user_id % 7 <> 0 THEN concat('org', user_id % 10) END AS orgId",
        "CAST(NULL AS STRING) AS ORG_ID",
        "concat('u', user_id) AS userId",
        "CAST(NULL AS STRING) AS USER_ID",
        "CASE WHEN k % 4 = 0 THEN concat('team', k % 5) END AS teamId",
        "'wx2-android' AS uaType",
        """named_struct(
            'verb', CASE event_type WHEN 'click' THEN 'post' WHEN 'view' THEN 'acknowledge'
                    WHEN 'purchase' THEN 'share' WHEN 'signup' THEN 'create' END,
            'object', named_struct('objectType', CASE WHEN event_type = 'click' THEN 'comment'
                    WHEN event_type = 'view' THEN 'activity' WHEN event_type = 'purchase' THEN 'content'
                    WHEN event_type = 'signup' AND k % 2 = 0 THEN 'conversation'
                    WHEN event_type = 'signup' THEN 'team' END),
            'target', named_struct('id', concat('room', k), 'objectType', 'conversation'),
            'convOneOnOne', CASE k % 4 WHEN 1 THEN true WHEN 2 THEN false END,
            'uaType', CASE event_id % 5 WHEN 0 THEN 'sparkmac' WHEN 1 THEN 'Firefox' WHEN 2 THEN 'Messenger'
                      WHEN 3 THEN 'mystery' END,
            'metricType', CASE WHEN event_type = 'error' THEN IF(k % 2 = 0, 'PARTICIPANT', 'DEVICE') END,
            'callType', CASE WHEN event_type = 'error' THEN IF(k % 10 <> 0, 'TERMINATED', 'STARTED') END,
            'squared', k % 3 <> 0,
            'locusType', CASE WHEN event_type = 'error' THEN elt(k % 4 + 1, 'CALL', 'CMRMEETING', 'JABBER',
                         'SPACEMEETING') END,
            'deviceType', elt(k % 5 + 1, 'DESKTOP', 'SIP', 'ROOMKIT', 'TP_ENDPOINT', 'WEB'),
            'orgId', CASE WHEN user_id % 14 = 0 THEN concat('org', user_id % 10) END,
            'userId', CAST(NULL AS STRING), 'uid', CAST(NULL AS STRING), 'onBoardedUser', CAST(NULL AS STRING),
            'actor', named_struct('orgId', CAST(NULL AS STRING), 'id', CAST(NULL AS STRING)),
            'participant', named_struct('orgId', CAST(NULL AS STRING), 'userId', CAST(NULL AS STRING))
        ) AS SM""",
    )


# The classified events as one flat CTE named `fact`.
CONVERSATION_SQL = """
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
raw AS (
  SELECT ts, event_type, k, event_type <> 'error' AS conv,
    CASE WHEN event_id % 50 <> 0 THEN 't' || event_id END AS dataid,
    coalesce(CASE WHEN user_id % 7 <> 0 THEN 'org' || (user_id % 10) END,
             CASE WHEN user_id % 14 = 0 THEN 'org' || (user_id % 10) END, 'unknown') AS orgId,
    'u' || user_id AS userId,
    k % 4 = 0 AS team, k % 4 = 1 AS one, k % 4 = 2 AS grp, 'room' || k AS room,
    CASE event_id % 5 WHEN 0 THEN 'sparkmac' WHEN 1 THEN 'Firefox' WHEN 2 THEN 'Messenger' WHEN 3 THEN 'mystery' END
      AS agent,
    CASE k % 4 WHEN 0 THEN 'CALL' WHEN 1 THEN 'CMRMEETING' WHEN 2 THEN 'JABBER' ELSE 'SPACEMEETING' END AS locus,
    CASE k % 5 WHEN 0 THEN 'DESKTOP' WHEN 1 THEN 'SIP' WHEN 2 THEN 'ROOMKIT' WHEN 3 THEN 'TP_ENDPOINT' ELSE 'WEB' END
      AS device
  FROM e),
kept AS (
  SELECT * FROM raw WHERE orgId NOT IN ('unknown', 'org3') AND userId <> 'u5' AND dataid IS NOT NULL AND (
    (conv AND agent IS NOT NULL AND agent <> 'Messenger')
    OR (NOT conv AND k % 10 <> 0 AND (
      (k % 2 = 0 AND k % 3 <> 0 AND locus = 'CALL')
      OR (k % 2 = 1 AND locus IN ('CMRMEETING', 'SPACEMEETING') AND device IN ('DESKTOP', 'WEB')))))),
fact AS (
  SELECT ts AS time_stamp, strftime(ts, '%Y-%m-%d') AS pdate, dataid, orgId, userId,
    CASE WHEN event_type = 'click' THEN 1 ELSE 0 END::BIGINT AS isMessage,
    CASE WHEN NOT conv AND k % 2 = 0 THEN 1 ELSE 0 END::BIGINT AS isCall,
    CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END::BIGINT AS isCreate,
    CASE WHEN one OR grp OR team THEN userId END AS rtUser,
    CASE WHEN one THEN userId END AS oneToOneUser, CASE WHEN grp THEN userId END AS groupUser,
    CASE WHEN team THEN userId END AS teamUser,
    CASE WHEN one THEN room END AS oneToOne, CASE WHEN grp THEN room END AS "group",
    CASE WHEN team THEN room END AS team, 'activeUser' AS relation_name,
    CASE WHEN conv THEN 'conv' ELSE 'locus' END AS appname,
    CASE WHEN NOT conv THEN locus END AS locustype,
    CASE event_type WHEN 'click' THEN 'post_comment' WHEN 'view' THEN 'acknowledge_activity'
      WHEN 'purchase' THEN 'share_content' WHEN 'error' THEN 'call'
      ELSE CASE WHEN k % 2 = 0 THEN 'create_conversation' ELSE 'create_team' END END AS activity,
    coalesce(agent, 'wx2-android') AS uaType,
    CASE coalesce(agent, 'wx2-android') WHEN 'sparkmac' THEN 'DESKTOP' WHEN 'Firefox' THEN 'WEB'
      WHEN 'wx2-android' THEN 'MOBILE' ELSE 'OTHER' END AS ua_category
  FROM kept)
"""


def call_legs(lineitem: DataFrame) -> DataFrame:
    """Call leg events, one per line item."""
    stamp = F.date_format("l_shipdate", STAMP)
    return lineitem.withColumn("_at", stamp).selectExpr(
        "'locus' AS _appname",
        "_at AS `@timestamp`",
        """named_struct('USER_ID', CASE WHEN l_partkey % 2 = 0 THEN concat('u', l_partkey) END,
            'uaVersion', concat('v', l_linenumber), 'LOCUS_ID', CAST(l_orderkey AS STRING),
            'locusStartTime', concat('s', l_orderkey)) AS `@fields`""",
        """named_struct(
            'orgId', concat('org', l_suppkey % 10),
            'uaType', CASE WHEN l_linenumber = 6 THEN 'UCConnector' WHEN l_linestatus = 'O' THEN 'sparkmac'
                      ELSE 'Chrome' END,
            'env', CASE l_linenumber WHEN 1 THEN 'PROD' WHEN 5 THEN 'TEST' END,
            'metricType', 'CALL_LEG', 'callType', 'TERMINATED',
            'legDuration', CAST(l_quantity * 10 AS BIGINT),
            'deviceType', CASE WHEN l_linenumber = 7 THEN CAST(NULL AS STRING) WHEN l_returnflag = 'A' THEN 'DESKTOP'
                          WHEN l_returnflag = 'N' THEN 'WEB' ELSE 'SPARK_SHARE' END,
            'userId', concat('w', l_partkey), 'uid', CAST(NULL AS STRING), 'onBoardedUser', CAST(NULL AS STRING),
            'actor', named_struct('id', CAST(NULL AS STRING)),
            'participant', named_struct('orgId', CAST(NULL AS STRING), 'userId', CAST(NULL AS STRING))) AS SM""",
        "CAST(NULL AS STRING) AS raw",
    )


LEGS_SQL = """
WITH leg AS (
  SELECT CAST(l_shipdate AS TIMESTAMP) AS time_stamp, strftime(l_shipdate, '%Y-%m-%d') AS pdate,
    'org' || (l_suppkey % 10) AS orgId,
    CASE WHEN l_partkey % 2 = 0 THEN 'u' || l_partkey ELSE 'w' || l_partkey END AS userId,
    'v' || l_linenumber AS uaVersion, CASE WHEN l_linestatus = 'O' THEN 'sparkmac' ELSE 'Chrome' END AS uaType,
    CAST(l_quantity * 10 AS BIGINT) AS legDuration, 'Spark' AS SOURCE,
    CASE WHEN l_linenumber = 7 THEN NULL WHEN l_returnflag = 'A' THEN 'DESKTOP' WHEN l_returnflag = 'N' THEN 'WEB'
      ELSE 'SPARK_SHARE' END AS deviceType,
    l_orderkey || '^s' || l_orderkey AS call_id, 'callDuration' AS relation_name
  FROM lineitem WHERE l_linenumber NOT IN (5, 6) AND l_suppkey % 10 <> 3),
counted AS (
  SELECT *, CASE coalesce(deviceType, '') || '|' || uaType WHEN 'DESKTOP|sparkmac' THEN 'Desktop'
    WHEN 'WEB|Chrome' THEN 'Web' WHEN '|sparkmac' THEN 'Desktop' ELSE 'Other' END AS ep1
  FROM leg WHERE deviceType IS NULL OR deviceType <> 'SPARK_SHARE')
"""


def quality_events(lineitem: DataFrame) -> DataFrame:
    """Call end events with histograms, one per line item."""
    return lineitem.withColumn("_at", F.date_format("l_shipdate", STAMP)).selectExpr(
        "'metrics' AS appname",
        "_at AS timeRcvd",
        "concat('org', l_suppkey % 10) AS orgId",
        "CASE WHEN l_partkey % 11 <> 0 THEN concat('u', l_partkey % 100) END AS userId",
        "CASE l_returnflag WHEN 'A' THEN 'sparkwindows' WHEN 'N' THEN 'sparkmac' ELSE 'wx2-android' END AS uaType",
        "'1.0' AS uaVersion",
        """named_struct(
            'sessionId', concat('c', l_orderkey),
            'key', CASE WHEN l_linenumber % 2 = 1 THEN 'callEnd_audio' ELSE 'callEnd_video' END,
            'value', named_struct(
                'clientCallDuration', l_quantity * 1000.0D,
                'locusId', CAST(l_orderkey AS STRING), 'locusTimestamp', CAST(l_linenumber AS STRING),
                'correlationId', concat('m', l_partkey),
                'mediaStatistics', named_struct('stats', named_struct(
                    'jitter', array(named_struct('duration', CAST(l_linenumber AS BIGINT), 'max', 0L,
                                                 'min', CAST(l_quantity * 6 AS BIGINT)),
                                    named_struct('duration', 2L, 'max', 0L, 'min', 40L)),
                    'rtt', array(named_struct('duration', 3L, 'max', 0L, 'min', CAST(l_quantity * 9 AS BIGINT))),
                    'lossRatio', array(named_struct('duration', CAST(l_linenumber - 1 AS BIGINT), 'max', 0L,
                                                    'min', CAST(l_quantity / 8 AS BIGINT)))
                )))) AS SM_C""",
        "CAST(NULL AS STRING) AS raw",
    )


QUALITY_SQL = """
WITH m AS (
  SELECT *, l_linenumber % 2 = 1 AS audio, CAST(trunc(l_quantity * 6) AS BIGINT) AS jmin,
    (l_linenumber * (CAST(trunc(l_quantity * 6) AS BIGINT) + 1) + 2 * 41)::DOUBLE / (l_linenumber + 2) AS jitter,
    (CAST(trunc(l_quantity * 9) AS BIGINT) + 1)::DOUBLE AS rtt,
    CASE WHEN l_linenumber = 1 THEN 0 ELSE (CAST(trunc(l_quantity / 8) AS BIGINT) + 1) END::DOUBLE AS loss
  FROM lineitem WHERE l_quantity * 1000 > 10000 AND l_returnflag IN ('A', 'N') AND l_suppkey % 10 <> 3),
quality AS (
  SELECT CAST(l_shipdate AS TIMESTAMP) AS time_stamp, strftime(l_shipdate, '%Y-%m-%d') AS pdate,
    'org' || (l_suppkey % 10) AS orgId,
    coalesce(CASE WHEN l_partkey % 11 <> 0 THEN 'u' || (l_partkey % 100) END, 'unknown') AS userId,
    l_quantity * 1000.0 AS duration, CASE WHEN audio THEN 'callEnd_audio' ELSE 'callEnd_video' END AS mediaType,
    l_orderkey || '^' || l_linenumber AS call_id,
    CASE WHEN audio THEN jitter END AS audio_jitter, CASE WHEN NOT audio THEN jitter END AS video_jitter,
    CASE WHEN audio THEN rtt END AS audio_rtt, CASE WHEN NOT audio THEN rtt END AS video_rtt,
    CASE WHEN audio THEN loss END AS audio_packetloss, CASE WHEN NOT audio THEN loss END AS video_packetloss,
    CASE l_returnflag WHEN 'A' THEN 'sparkwindows' ELSE 'sparkmac' END AS uaType,
    'c' || l_orderkey AS confId, 'm' || l_partkey AS meetingId,
    CASE WHEN audio AND jitter <= 150 AND rtt <= 400 AND loss <= 5 THEN 1 ELSE 0 END::BIGINT AS audio_is_good,
    CASE WHEN NOT audio THEN 1 ELSE 0 END::BIGINT AS video_is_good
  FROM m)
"""


def share_events(documents: DataFrame) -> DataFrame:
    """Share events, one per document."""
    day = F.expr("date_add(DATE'2024-01-01', CAST(doc_id % 60 AS INT))").cast("timestamp")
    return documents.withColumn("_at", F.date_format(day, STAMP)).selectExpr(
        "CASE WHEN doc_id % 13 = 0 THEN 'other' ELSE 'conv' END AS _appname",
        "_at AS `@timestamp`",
        "CASE WHEN source <> 'src2' THEN source END AS orgId",
        "lang AS userId",
        "named_struct('USER_ID', CAST(NULL AS STRING)) AS `@fields`",
        """named_struct('verb', 'share',
            'object', named_struct('objectType', IF(n_chars % 5 <> 0, 'content', 'link'), 'contentSize', n_chars),
            'orgId', CAST(NULL AS STRING), 'userId', CAST(NULL AS STRING), 'uid', CAST(NULL AS STRING),
            'onBoardedUser', CAST(NULL AS STRING),
            'actor', named_struct('orgId', CAST(NULL AS STRING), 'id', CAST(NULL AS STRING)),
            'participant', named_struct('orgId', CAST(NULL AS STRING), 'userId', CAST(NULL AS STRING))) AS SM""",
        "CAST(NULL AS STRING) AS raw",
    )


SHARES_SQL = """
WITH share AS (
  SELECT CAST(DATE '2024-01-01' + CAST(doc_id % 60 AS INT) AS TIMESTAMP) AS time_stamp,
    strftime(DATE '2024-01-01' + CAST(doc_id % 60 AS INT), '%Y-%m-%d') AS pdate,
    source AS orgId, lang AS userId, CASE WHEN n_chars % 5 <> 0 THEN 1 ELSE 0 END::BIGINT AS isFile,
    n_chars AS contentSize
  FROM documents WHERE doc_id % 13 <> 0 AND source NOT IN ('src2', 'src3')),
used AS (
  SELECT strftime(time_stamp, '%Y-%m-%d %H:%M:%S') AS time_stamp, pdate,
    'fileUsed^' || strftime(time_stamp, '%Y-%m-%d %H:%M:%S') || '^' || orgId || '^' || userId || '^' || contentSize
      AS dataid, orgId, userId, isFile, contentSize, 'fileUsed' AS relation_name
  FROM share)
"""


def device_events(orders: DataFrame) -> DataFrame:
    """Device information events, one per order."""
    return orders.withColumn("_at", F.date_format("o_orderdate", STAMP)).selectExpr(
        "'metrics' AS appname",
        "_at AS timeRcvd",
        "CASE WHEN o_custkey % 9 <> 0 THEN concat('org', o_custkey % 10) END AS orgId",
        "CASE o_orderstatus WHEN 'F' THEN 'ce' WHEN 'O' THEN 'SparkBoard' ELSE 'sparkmac' END AS uaType",
        """named_struct('key', CASE WHEN o_orderkey % 2 = 0 THEN 'sysinfo' ELSE 'sysinfo_darling' END,
            'value', named_struct('deviceIdentifier', concat('d', o_custkey),
                'model', CASE o_orderpriority WHEN '1-URGENT' THEN 'Room 70D' WHEN '2-HIGH' THEN 'SparkBoard 55'
                         WHEN '3-MEDIUM' THEN 'Board' WHEN '5-LOW' THEN 'Kit' END)) AS SM_C""",
        "CAST(NULL AS STRING) AS raw",
    )


DEVICES_SQL = """
WITH device AS (
  SELECT CAST(o_orderdate AS TIMESTAMP) AS time_stamp, strftime(o_orderdate, '%Y-%m-%d') AS pdate,
    'org' || (o_custkey % 10) AS orgId, 'NA' AS userId, 'd' || o_custkey AS deviceId,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Undefined' WHEN '2-HIGH' THEN 'SPARK-BOARD55'
      WHEN '3-MEDIUM' THEN 'Board' WHEN '5-LOW' THEN 'Kit' ELSE 'unknown' END AS model,
    'registeredEndpoint' AS relation_name
  FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_custkey % 9 <> 0 AND o_custkey % 10 <> 3)
"""


def provisioning_events(part: DataFrame) -> DataFrame:
    """Licence events, one per part."""
    day = F.expr("date_add(DATE'2024-01-01', CAST(p_partkey % 30 AS INT))").cast("timestamp")
    return part.withColumn("_at", F.date_format(day, STAMP)).selectExpr(
        "_at AS `@timestamp`",
        """named_struct(
            'className', IF(p_size % 2 = 0, 'ProvisioningMetricEvent', 'InviteMetricEvent'),
            'autoTemplate', IF(p_size % 3 = 0, 'true', 'false'),
            'provAction', elt(CAST(p_partkey % 3 AS INT) + 1, 'ADD', 'PATCH', 'DROP'),
            'inviteType', IF(p_partkey % 2 = 0, 'ADMIN_INVITE', 'USER_INVITE'),
            'licenses', transform(split(p_name, ' '), w -> concat(w, '_', p_size)),
            'adminId', p_brand, 'onboardMethod', p_type,
            'provStatus', IF(p_partkey % 5 = 0, CAST(NULL AS STRING), 'SUCCESS'), 'inviteStatus', 'SENT',
            'errTxt', CAST(NULL AS STRING),
            'inviteeID', IF(p_partkey % 4 = 0, concat('i', p_partkey), CAST(NULL AS STRING)),
            'userId', concat('u', p_partkey), 'orgId', concat('org', p_size % 10)) AS SM""",
        "CAST(p_partkey AS STRING) AS raw",
    )
