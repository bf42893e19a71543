from pyspark.sql import functions as F

from tallyford.monitors import call_volume, common, devices, licences, tables, volume


def calls(spark):
    """Records per day of four organisations; other time texts do not count."""
    per_day = {"A": {"15": 14, "16": 2}, "B": {"14": 2, "15": 2, "16": 70}, "C": {"15": 2, "16": 4}, "D": {"15": 2, "16": 2}}
    rows = [(org, f"2019-01-{d}T10:00:{i % 60:02d}.000Z") for org, days in per_day.items() for d, n in days.items()
            for i in range(n)]
    rows += [("A", ""), ("A", None), ("A", "soon"), ("C", "2019-01-12T10:00:00Z"), ("D", "2019-01-17T01:00:00Z")]
    return spark.createDataFrame(rows, "org_id string, locus_start_time string")


def test_call_volume_table(spark):
    model = call_volume.model(calls(spark), "2019-01-17", 30, 50)
    rows = call_volume.alerts(calls(spark), model, "2019-01-16", 0.8, "now", 50)
    got = {r.org_id: (round(r.historyAvg, 2), r.currentAvg, r.percentage, r.status) for r in rows.collect()}
    assert got == {
        "A": (8.0, 2.0, 25, "true"), "B": (24.67, 70.0, 283, "true"), "C": (3.0, 4.0, 133, "false"),
        "D": (2.0, 2.0, 100, "false")}


def test_call_volume_top_orgs_and_missing_orgs(spark):
    model = call_volume.model(calls(spark), "2019-01-17", 30, 2)
    assert [r.org_id for r in model.orderBy("avg").collect()] == ["A", "B"]
    only_b = calls(spark).where("org_id <> 'A'")
    rows = call_volume.alerts(only_b, model, "2019-01-16", 0.8, orgs=2)
    assert {r.org_id: (r.currentAvg, r.status) for r in rows.collect()} == {"A": (0.0, "true"), "B": (70.0, "true")}


def test_call_volume_without_any_data(spark):
    model = call_volume.model(calls(spark), "2019-01-17", 30, 50)
    for day in ("2019-01-18", "2019-01-19"):  # also on a day off
        rows = call_volume.alerts(calls(spark), model, day, 0.8, orgs=50).collect()
        assert [(r.org_id, r.currentAvg, r.percentage, r.status) for r in rows] == [
            ("All Top 50 Orgs Have No Data", 0.0, 0, "true")]
    assert call_volume.alerts(calls(spark), model.limit(0), "2019-01-18", 0.8).count() == 0


def test_call_volume_day_off(spark):
    model = call_volume.model(calls(spark), "2019-01-17", 30, 50)
    assert call_volume.alerts(calls(spark), model, "2019-01-12", 0.8).count() == 0
    rows = call_volume.alerts(calls(spark), model, "2019-01-16", 0.8, "now")
    message = call_volume.messages(rows).where("metrics.id = 'A'").head()
    assert (message.component, message.eventTime, message.metrics.time, message.metrics.isAlert) == (
        "CRS", "now", "2019-01-16", "true")
    assert message.metrics.value.volume == 2.0 and message.metrics.value.threshold == "0.8"


AGG = ("orgid string, relation_name string, period string, day string, files bigint, usercountbyorg bigint, "
       "messages bigint, ua_category string, ep1 string, number_of_successful_calls bigint, "
       "number_of_total_calls bigint, number_of_bad_calls bigint")


def aggregates(spark, rows):
    """(org, relation, period, day, count) rows in the shape of the aggregate table."""
    place = {"fileUsed": 4, "activeUser": 5, "messageSent": 6, "callDuration": 9, "callQuality": 10}
    out = []
    for org, relation, period, day, n in rows:
        row = [org, relation, period, day, None, None, None, "DESKTOP", "Desktop", None, None, 0]
        row[place[relation]] = n
        out.append(tuple(row))
    return spark.createDataFrame(out, AGG).withColumn("time_stamp", F.col("day").cast("timestamp")).drop("day")


def test_volume_flags(spark):
    rows = [("a", "activeUser", "daily", f"2019-01-{d:02d}", 1000) for d in range(7, 12)]
    rows += [("b", "fileUsed", "daily", f"2019-01-{d:02d}", 200) for d in range(7, 12)]
    rows += [("c", "activeUser", "daily", f"2019-01-{d:02d}", 700) for d in range(7, 12)]
    rows += [("a", "callQuality", "weekly", "2019-01-06", 500), ("a", "activeUser", "daily", "2019-01-12", 1)]
    rows += [("a", "activeUser", "daily", "2019-01-14", 300), ("b", "fileUsed", "daily", "2019-01-14", 0),
             ("c", "activeUser", "daily", "2019-01-14", 1), ("z", "activeUser", "daily", "2019-01-14", 5)]
    got = volume.run(aggregates(spark, rows), ["a", "b", "c"], "2019-01-14", 0.5)
    found = {(r.orgid, r.relation_name): (r["count"], r.avg, r.percentage, r.status) for r in got.collect()}
    # Saturday's count of `a` is not in a Monday's average; `c` is below the floor; `z` is not listed.
    assert found[("a", "activeUser")] == (300, 1000.0, 30, "failure")
    assert found[("b", "fileUsed")] == (0, 200.0, 0, "failure")
    assert found[("c", "activeUser")] == (1, 700.0, 0, "success")
    assert ("z", "activeUser") not in found
    # No organisation sent messages: a relation without history does not show up.
    assert found[("orgCount", "activeUser")][0] == 3 and ("orgCount", "messageSent") not in found


def test_org_count_is_zero_without_rows(spark):
    rows = aggregates(spark, [("a", "activeUser", "daily", "2019-01-14", 1), ("a", "fileUsed", "daily", "2019-01-11", 1)])
    got = volume.run(rows, ["a"], "2019-01-14", 0.5).where("orgid = 'orgCount'").collect()
    # Four relations nobody reported on the day: only the one with a history has an average to stand beside.
    assert [(r.relation_name, r["count"], r.avg) for r in got] == [("fileUsed", 0, 1.0)]


def test_volume_reports_of_a_day_stay_rows(spark):
    """Two reports of one day are two rows, equal ones too, and a missing count is a row without one."""
    rows = [("a", "activeUser", "daily", "2019-01-11", n) for n in (10, 20, None)]
    rows += [("a", "activeUser", "daily", "2019-01-14", n) for n in (7, 7, 8, None)]
    got = volume.run(aggregates(spark, rows), ["a"], "2019-01-14", 0.5).collect()
    assert sorted((r["count"] is None, r["count"], r.avg) for r in got if r.orgid == "a") == [
        (False, 7, 15.0), (False, 7, 15.0), (False, 8, 15.0), (True, None, 15.0)]
    assert [(r["count"], r.avg) for r in got if r.orgid == "orgCount"] == [(4, 3.0)]
    assert volume.run(aggregates(spark, rows), ["a"], "2019-01-14", 0.5, org="b").where("orgid = 'a'").count() == 0


def test_volume_names_and_messages(spark):
    rows = aggregates(spark, [("a", r, p, "2019-01-14", 7) for r in volume.COUNTED for p in ("daily", "weekly")])
    got = {r.relation_name: r["count"] for r in volume.counts(rows, ["a"]).where("not of_all").collect()}
    names = ["fileUsed", "activeUser", "messageSent", "number_of_total_calls", "number_of_good_calls"]
    assert got == {n + s: 7 for n in names for s in ("", "-weekly")}
    flagged = spark.sql("SELECT 'a' orgid, 'fileUsed' relation_name, '2019-01-14' pdate, 1L count, 2D avg, "
                        "50 percentage, 'success' status")
    data = volume.messages(flagged).head().metrics
    assert (data.sendTime, data.data.name, data.data.historicalAverageVolume) == ("2019-01-14T00:00:00Z", "a_fileUsed", 2.0)


def test_licence_monitor(spark):
    rows = [("a", "u1", "2019-01-14", "SUCCESS"), ("a", "u1", "2019-01-14", "SUCCESS"), ("a", "u2", "2019-01-14", "FAILED"),
            ("a", "u1", "2019-01-11", "SUCCESS"), ("a", "u2", "2019-01-11", "SUCCESS"), ("a", "u1", "2019-01-10", "SUCCESS"),
            ("a", "u3", "2019-01-12", "SUCCESS"), ("a", "u9", "2018-12-12", "SUCCESS"), ("b", "u1", "2019-01-14", "SUCCESS"),
            ("c", "u1", "2019-01-11", "SUCCESS")]
    df = spark.createDataFrame(rows, "orgid string, userid string, pdate string, status string").withColumn(
        "relation_name", F.lit("license"))
    got = licences.run(df, ["a", "b", "c"], "2019-01-14")
    assert [tuple(r) for r in got.collect()] == [("a", "2019-01-14", 1, True, 1)]
    assert licences.messages(got).head().metrics.data.licenseCount == 1


def usage(spark, rows):
    return spark.createDataFrame(rows, "orgid string, pdate string, deviceid string, incall double, "
                                 "local_share_cable double, local_share_wireless double, white_boarding double")


def test_device_usage(spark):
    same = [(o, d, v, 10.0, 20.0, 30.0, 40.0) for o in ("a", "b", "c") for d in ("2019-01-10", "2019-01-11") for v in "xy"]
    today = [("a", "2019-01-14", "x", 11.0, 20.0, 30.0, 40.0), ("b", "2019-01-14", "x", 30.0, 20.0, 30.0, 40.0),
             ("c", "2019-01-14", "x", None, 20.0, 30.0, 40.0), ("d", "2019-01-14", "x", 1.0, 1.0, 1.0, 1.0)]
    rows = devices.run(usage(spark, same + today), ["a", "b", "c", "d"], "2019-01-14")
    normal = devices.normal_rows(rows, 0.2).collect()
    odd = {r.orgid: r.incallDiffPctg for r in devices.anomalies(rows, 0.2).collect()}
    assert [(r.orgid, r.deviceCount, r.incallAvg, r.incallDiffPctg) for r in normal] == [("a", 1, 10, 10)]
    assert odd == {"b": 200, "c": None}
    assert devices.messages(devices.anomalies(rows, 0.2), True).head().metrics.data.isAlert == "true"


def test_table_sums(spark):
    base = spark.createDataFrame(
        [("a", "callDuration", "2019-01-14", "bc", 5, None), ("a", "callDuration", "2019-01-14", "bc", 7, "g"),
         ("a", "callDuration", "2019-01-14", "x", 9, None), ("a", "callDuration", "2019-01-13", "bc", 1, None),
         ("a", "other", "2019-01-14", "bc", 1, None), ("q", "callDuration", "2019-01-14", "bc", 1, None)],
        "orgid string, relation_name string, pdate string, source string, legduration int, `group` string")
    facts = base.withColumns({c: F.lit(None).cast("int") for c in tables.DATA_SUMS.values() if c != "legduration"})
    row = tables.data_sums(facts, ["a"], "2019-01-14", "EU").head()
    assert (row.relation_name, row.legduration, row.number_of_groups, row.call, row.region) == ("callDuration", 21, 1, None, "EU")
    assert tables.data_sums(facts, ["a"], "2019-01-14", relations="other").head().region is None
    daily = tables.daily_duration(facts, ["a"], "2019-01-14")
    assert [r.legduration for r in daily.collect()] == [12]
    assert tables.daily_messages(daily, "BCDuration").head().metrics.data.reportDate == "2019-01-14"
    assert tables.table_messages(tables.data_sums(facts, ["a"], "2019-01-14"), "pdate").head().metrics.pipeLine == "callDuration"


def test_days():
    assert common.days_before("2019-01-04", 3) == ["2019-01-02", "2019-01-03"]
    assert common.business_days_before("2019-01-04", 5) == ["2018-12-31", "2019-01-02", "2019-01-03"]
    assert common.like_days_before("2019-01-05", 5) == ["2019-01-01"]
    assert common.monitored_day(None, "2019-01-05") == "2019-01-04" and common.monitored_day("x") == "x"
