"""Reports on hand-made events, and the same job in batch and as a stream."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyford.operators.lookups import mapping_table, member_list
from tallyford.plans.jobs import Job, run_plan
from tallyford.plans.steps import Lookups, report_steps
from tallyford.reports import calls, content, devices, licences, regions, usage
from tallyford.session import fresh_path
from tallyford.sinks.tables import KeyedTable

EVENT = ("""
    timeRcvd STRING, orgId STRING, ORG_ID STRING, userId STRING, USER_ID STRING, teamId STRING, trackingId STRING,
    appname STRING, uaType STRING, SM STRUCT<uaType STRING, metricType STRING, callType STRING, locusType STRING,
    deviceType STRING, orgId STRING, userId STRING, uid STRING, onBoardedUser STRING, verb STRING, squared BOOLEAN,
    convOneOnOne BOOLEAN, participant STRUCT<orgId STRING, userId STRING>, actor STRUCT<orgId STRING, id STRING>,
    object STRUCT<objectType STRING>, target STRUCT<objectType STRING, id STRING>>""")


def lookups(spark):
    return Lookups(
        member_list(spark, ["bad"], "o"), member_list(spark, ["tester"], "u"), mapping_table(spark, {"sparkmac": "DESKTOP"}),
        mapping_table(spark, {"DESKTOP|sparkmac": "Desktop"}),
        spark.createDataFrame([("o1", "EU"), ("o2", "US")], "orgId string, region string"), room_device_prefix="ROOM")


def event(i=1, app="conv", org="o1", user="u1", team=None, day=3, **sm):
    sm = {"verb": "post", "object": {"objectType": "comment"}, "target": {"id": "r1"}, "uaType": "sparkmac",
          "convOneOnOne": True, **sm}
    return {"timeRcvd": f"2018-05-{day:02d}T10:00:00.000Z", "orgId": org, "userId": user, "teamId": team,
            "trackingId": f"t{i}", "appname": app, "SM": sm}


CALL = {"verb": None, "object": None, "target": None, "convOneOnOne": None, "metricType": "PARTICIPANT",
        "callType": "TERMINATED", "squared": True, "locusType": "CALL"}
MEETING = {**CALL, "metricType": "DEVICE", "squared": None, "locusType": "CMRMEETING", "deviceType": "WEB"}


def facts(spark, *events):
    df = spark.createDataFrame([(json.dumps(e),) for e in events], "value string")
    rows = df.select(F.from_json("value", EVENT).alias("d")).select("d.*").withColumn(
        "timeRcvd", F.to_timestamp("timeRcvd"))
    known = lookups(spark)
    return usage.active_users(rows, known.excluded_orgs, known.test_users, known.agents, room_device_prefix="ROOM")


@pytest.mark.parametrize("change,kept", [
    ({}, True), ({"org": "bad"}, False), ({"user": "tester"}, False), ({"org": None}, False), ({"user": None}, True),
    ({"uaType": "Messenger"}, False), ({"uaType": None}, False), ({"verb": "delete"}, False),
    ({"verb": "add", "object": {"objectType": "person"}, "target": {"objectType": "conversation"}}, True),
    ({"verb": "add", "object": {"objectType": "person"}, "target": {"objectType": "team"}}, False),
    ({"app": "other"}, False),
    ({"app": "locus", **CALL}, True), ({"app": "locus", **CALL, "squared": False}, False),
    ({"app": "locus", **CALL, "locusType": "JABBER"}, False), ({"app": "locus", **CALL, "callType": "STARTED"}, False),
    ({"app": "locus", **MEETING}, True), ({"app": "locus", **MEETING, "deviceType": "SIP"}, False),
    ({"app": "locus", **MEETING, "deviceType": "ROOM70"}, False), ({"app": "locus", **MEETING, "deviceType": None}, False),
    ({"app": "locus", **MEETING, "locusType": "CALL"}, False),
])
def test_which_events_count(spark, change, kept):
    assert facts(spark, event(**change)).count() == int(kept)


def test_events_without_an_id_do_not_count(spark):
    assert facts(spark, {**event(), "trackingId": None}).count() == 0


def test_rooms(spark):
    rows = facts(spark, event(1), event(2, convOneOnOne=False), event(3, team="t"), event(4, convOneOnOne=None))
    got = {r.dataid: (r.oneToOne, r.group, r.team, r.rtUser, r.isMessage, r.ua_category) for r in rows.collect()}
    assert got == {
        "t1": ("r1", None, None, "u1", 1, "DESKTOP"), "t2": (None, "r1", None, "u1", 1, "DESKTOP"),
        "t3": ("r1", None, "r1", "u1", 1, "DESKTOP"), "t4": (None, None, None, None, 1, "DESKTOP")}
    call = facts(spark, event(app="locus", **CALL)).head()
    assert (call.isCall, call.activity, call.locustype) == (1, "call", "CALL")


def test_user_reports(spark):
    rows = facts(spark, event(1), event(2), event(3, user="u2", target={"id": "r2"}), event(4, day=4),
                 event(5, app="locus", **CALL))
    count = usage.active_user_count(rows, "daily").orderBy("time_stamp").collect()
    assert [(r.eventKey, r.userCountByOrg) for r in count] == [
        ("2018-05-03 00:00:00^o1^activeUser^daily", 2), ("2018-05-04 00:00:00^o1^activeUser^daily", 1)]
    assert [r.oneToOneCount for r in usage.one_to_one_count(rows, "weekly").collect()] == [2]
    assert [r.spaceCount for r in usage.space_count(rows, "monthly").collect()] == [0]
    roll = {r.dataid: (r.isMessage, r.isCall) for r in usage.user_day_rollup(rows).collect()}
    assert roll == {"2018-05-03^o1^u1": (2, 1), "2018-05-03^o1^u2": (1, 0), "2018-05-04^o1^u1": (1, 0)}
    assert {r.dataid for r in usage.room_users(rows).collect()} == {
        "2018-05-03^o1^rtUser^r1^0", "2018-05-03^o1^rtUser^r2^0", "2018-05-03^o1^rtUser^0^0", "2018-05-04^o1^rtUser^r1^0"}
    top = {(r.userId, r.messages + r.calls) for r in usage.top_users(rows, "weekly", 1).collect()}
    assert top == {("u1", 4)}


def test_regions(spark):
    known = lookups(spark).regions
    users = spark.createDataFrame([("o1",), ("o2",), ("o3",)], "orgId string")
    names = lambda df: [r.orgId for r in df.orderBy("orgId").collect()]
    assert names(regions.in_region(users, known)) == ["o1"]
    assert names(regions.outside_region(users, known)) == ["o2", "o3"]
    assert names(regions.without_region(users, known)) == ["o3"]


LEG = ("""
    `@timestamp` STRING, _appname STRING, `@fields` STRUCT<uaVersion STRING, USER_ID STRING, LOCUS_ID STRING,
    locusStartTime STRING>, SM STRUCT<onBoardedUser STRING, uid STRING, env STRING, orgId STRING, userId STRING,
    metricType STRING, callType STRING, deviceType STRING, uaType STRING, legDuration BIGINT, actor STRUCT<id STRING>,
    participant STRUCT<orgId STRING, userId STRING>>, raw STRING""")


def leg(call="c1", seconds=60, device="DESKTOP", **sm):
    return {"@timestamp": "2018-05-03T10:00:00.000Z", "_appname": "locus",
            "@fields": {"LOCUS_ID": call, "locusStartTime": "s"},
            "SM": {"orgId": "o1", "userId": "u1", "metricType": "CALL_LEG", "callType": "TERMINATED", "uaType": "sparkmac",
                   "deviceType": device, "legDuration": seconds, **sm}}


def shaped(spark, schema, rows):
    df = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
    return df.select(F.from_json("value", schema).alias("d")).select("d.*")


def test_call_legs(spark):
    known = lookups(spark)
    rows = [leg(), leg(seconds=31), leg("c2", device=None), leg("c3", device="SPARK_SHARE"), leg("c4", env="TEST"),
            leg("c5", env="PROD"), leg("c6", uaType="UCConnector"), leg("c7", orgId="bad"), leg("c8", orgId=None)]
    legs = calls.call_duration(shaped(spark, LEG, rows), known.excluded_orgs)
    assert sorted(r.call_id for r in legs.collect()) == ["c1^s", "c1^s", "c2^s", "c3^s", "c5^s"]
    assert len({r.dataid for r in legs.collect()}) == 5
    minutes = {r.ep1: r.number_of_minutes for r in calls.call_minutes(legs, known.endpoints, "daily").collect()}
    assert minutes == {"Desktop": 3, "Other": 1}  # 151 seconds, 60 seconds
    total = {r.ep1: r.number_of_successful_calls for r in calls.total_calls(legs, known.endpoints, "daily").collect()}
    assert total == {"Desktop": 2, "Other": 1}


METRIC = ("""
    timeRcvd STRING, uaType STRING, uaVersion STRING, orgId STRING, userId STRING, appname STRING, raw STRING,
    SM_C STRUCT<sessionId STRING, key STRING, value STRUCT<deviceIdentifier STRING, correlationId STRING, model STRING,
    locusTimestamp STRING, locusId STRING, clientCallDuration DOUBLE, mediaStatistics STRUCT<stats STRUCT<
    lossRatio ARRAY<STRUCT<duration BIGINT, max BIGINT, min BIGINT>>,
    rtt ARRAY<STRUCT<duration BIGINT, max BIGINT, min BIGINT>>,
    jitter ARRAY<STRUCT<duration BIGINT, max BIGINT, min BIGINT>>>>>>""")


def metric(call="c1", key="callEnd_audio", jitter=10, agent="sparkmac", duration=20000.0, user="u1", **value):
    flat = lambda n: [{"duration": 1, "max": n, "min": n}]
    return {"timeRcvd": "2018-05-03T10:00:00.000Z", "uaType": agent, "orgId": "o1", "userId": user, "appname": "metrics",
            "SM_C": {"key": key, "value": {
                "locusId": call, "locusTimestamp": "s", "clientCallDuration": duration,
                "mediaStatistics": {"stats": {"jitter": flat(jitter), "rtt": flat(1), "lossRatio": []}}, **value}}}


def test_call_quality(spark):
    known = lookups(spark)
    rows = [metric(), metric("c2", jitter=150), metric("c2", jitter=149), metric("c3", "callEnd_video"),
            metric("c4", duration=10000.0), metric("c5", agent="other"), metric("c6", "other")]
    quality = calls.call_quality(shaped(spark, METRIC, rows), known.excluded_orgs)
    got = sorted((r.call_id, r.audio_jitter, r.video_jitter, r.audio_packetloss, r.audio_is_good, r.video_is_good)
                 for r in quality.fillna(-1).collect())
    assert got == [("c1^s", 11.0, -1.0, 0.0, 1, 0), ("c2^s", 150.0, -1.0, 0.0, 1, 0), ("c2^s", 151.0, -1.0, 0.0, 0, 0),
                   ("c3^s", -1.0, 11.0, -1.0, 0, 1)]
    assert calls.bad_calls(quality, "daily").head().number_of_bad_calls == 1
    assert calls.all_calls(quality, "daily").head().number_of_total_calls == 3
    assert [(r.userId, r.number_of_bad_calls) for r in calls.top_poor_quality(quality, "daily").collect()] == [("u1", 1)]


def test_devices(spark):
    rows = [metric(key="sysinfo", agent="ce", model=m, deviceIdentifier=d)
            for m, d in (("Room 70D", "d1"), ("Room 70D", "d1"), ("SparkBoard 55", "d2"), (None, "d3"), ("X", "d4"))]
    facts_ = devices.registered_endpoints(shaped(spark, METRIC, rows + [metric()]), lookups(spark).excluded_orgs)
    got = {r.model: r.registeredEndpointCount for r in devices.endpoint_count(facts_, "monthly").collect()}
    assert got == {"Undefined": 1, "SPARK-BOARD55": 1, "unknown": 1, "X": 1}


def test_files(spark):
    schema = StructType.fromDDL("""
        `@timestamp` STRING, _appname STRING, orgId STRING, userId STRING, `@fields` STRUCT<USER_ID STRING>, raw STRING,
        SM STRUCT<verb STRING, orgId STRING, userId STRING, uid STRING, onBoardedUser STRING,
        object STRUCT<objectType STRING, contentSize BIGINT>, actor STRUCT<orgId STRING, id STRING>,
        participant STRUCT<orgId STRING, userId STRING>>""")
    share = lambda size, kind="content", verb="share": {
        "@timestamp": "2018-05-03T10:00:00.000Z", "_appname": "conv", "orgId": "o1", "userId": "u1",
        "SM": {"verb": verb, "object": {"objectType": kind, "contentSize": size}}}
    used = content.files_used(
        shaped(spark, schema, [share(5), share(5), share(7), share(9, "link"), share(1, verb="post")]),
        lookups(spark).excluded_orgs)
    assert used.count() == 4 and used.head().dataid == "fileUsed^2018-05-03 10:00:00^o1^u1^5"
    row = content.file_count(used, "daily").head()
    assert (row.files, row.fileSize) == (2, 21)


def test_licences(spark):
    schema = StructType.fromDDL("""
        `@timestamp` STRING, raw STRING, SM STRUCT<className STRING, autoTemplate STRING, adminId STRING, onboardMethod STRING,
        orgId STRING, userId STRING, inviteeID STRING, inviteType STRING, provAction STRING, provStatus STRING,
        inviteStatus STRING, errTxt STRING, licenses ARRAY<STRING>>""")
    provision = {"className": "ProvisioningMetricEvent", "provAction": "ADD", "userId": "u", "provStatus": "SUCCESS",
                 "licenses": ["MS_1", "CF_2"]}
    invite = {"className": "InviteMetricEvent", "inviteType": "ADMIN_INVITE", "inviteeID": "i", "userId": "u",
              "inviteStatus": "SENT", "autoTemplate": "true", "licenses": ["MS"]}
    no = [{**provision, "provAction": "PATCH"}, {**invite, "inviteType": "x", "autoTemplate": "false"},
          {**provision, "licenses": []}]
    rows = [{"@timestamp": "2018-05-03T10:00:00.000Z", "SM": sm} for sm in (provision, invite, *no)]
    got = licences.auto_licences(shaped(spark, schema, rows)).collect()
    assert sorted((r.licenses, r.licensesassign, r.status, r.userid) for r in got) == [
        ("CF", "MANUAL", "SUCCESS", "u"), ("MS", "AUTO", "SENT", "i"), ("MS", "MANUAL", "SUCCESS", "u")]
    assert len({r.dataid for r in got}) == 3


AGGREGATE = ("eventKey STRING, time_stamp TIMESTAMP, orgId STRING, userCountByOrg BIGINT, oneToOneCount BIGINT, "
             "spaceCount BIGINT, period STRING, relation_name STRING")


@pytest.mark.parametrize("mode", ["batch", "stream"])
def test_active_user_job(spark, tmp_path, mode):
    """Raw lines to facts, facts to three counts in one table row each; the stream goes through files in between."""
    (tmp_path / "raw").mkdir()
    events = [event(1), event(2, user="u2"), event(3, user="u2", convOneOnOne=False), event(4, org="bad"), event(5, day=4)]
    for i, e in enumerate(events):
        (tmp_path / "raw" / f"{i}.json").write_text(json.dumps(e) + "\n")
    table = KeyedTable(fresh_path(spark, "agg"), AGGREGATE, ["eventKey", "time_stamp"])
    fact_schema = StructType.fromDDL(
        "time_stamp STRING, pdate STRING, orgId STRING, userId STRING, oneToOne STRING, `group` STRING")
    settings = {"dataLocation": str(tmp_path), "trigger": None,
                "spark": {"streamingCheckpointLocation": fresh_path(spark, "ck")}}
    job = Job(spark, mode, settings, report_steps(lookups(spark)), schemas={"conv": StructType.fromDDL(EVENT), "fact": fact_schema},
              tables={"agg": table})
    name = f"facts{uuid.uuid4().hex}"
    run = lambda stages: [r.query.awaitTermination() for r in run_plan(job, stages) if r.query]
    step = lambda n, **p: {"queryName": n, "parameters": p}
    run([[step("readFromFile", input="raw", format="json", schemaName="conv", timeStampField="timeRcvd")],
         [step("activeUser", output=name)],
         [step("writeToFile", format="json", saveMode="append")]])
    counts = ["activeUserCount", "oneToOneCount", "spaceCount"]
    run([[step("readFromFile", input=name, format="json", schemaName="fact", timeStampField="time_stamp")],
         [step(n, aggregatePeriod="daily", timeStampField="time_stamp", output=f"{n}{name}") for n in counts],
         [step("writeToCassandra", cassandra={"table": "agg", "saveMode": "update"})]])
    got = {r.time_stamp: (r.userCountByOrg, r.oneToOneCount, r.spaceCount) for r in table.read(spark).collect()}
    assert got == {dt.datetime(2018, 5, 3): (2, 1, 1), dt.datetime(2018, 5, 4): (1, 1, 0)}
