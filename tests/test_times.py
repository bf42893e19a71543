import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyford.functions import times


def one(spark, column, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(
        f"{n} {'timestamp' if isinstance(v, dt.datetime) else 'bigint' if isinstance(v, int) else 'string'}"
        for n, v in values.items())) if names else spark.range(1)
    return df.select(column.alias("x")).head()["x"]


@pytest.mark.parametrize("text,want", [
    ("2018-05-03T10:11:12Z", "2018-05-03 10:11:12.000"),
    ("2018-05-03T10:11:12.345Z", "2018-05-03 10:11:12.345"),
    ("2018-05-03", "2018-05-03 00:00:00.000"),
    ("2018-05-03 and more", "2018-05-03 00:00:00.000"),
    ("03/05/2018", None),
    ("", None),
    (None, None),
])
def test_stamps(spark, text, want):
    shown = F.date_format(times.parse_stamp("s"), "yyyy-MM-dd HH:mm:ss.SSS")
    assert one(spark, shown, s=text) == want


def test_unreadable_stamp_can_be_now(spark):
    assert one(spark, times.parse_stamp("s", "now"), s="bad").date() >= dt.date(2024, 1, 1)
    with pytest.raises(ValueError):
        times.parse_stamp("s", "never")


def test_days_and_minutes(spark):
    at = dt.datetime(2018, 5, 3, 23, 59, 58)
    assert one(spark, times.iso_day("t"), t=at) == "2018-05-03"
    assert one(spark, times.iso_minute("t"), t=at) == "2018-05-03 23:59"
    assert one(spark, times.end_of_day("t"), t=at) == dt.datetime(2018, 5, 3, 23, 59, 59)
    assert one(spark, times.text_day("s"), s="2018-05-03T00:00:00Z") == "2018-05-03"
    assert one(spark, times.unix_day("n"), n=1525305600) == "2018-05-03"
    assert one(spark, times.leading_day("s"), s="2018-05-03T01:00") == "2018-05-03"
    assert one(spark, times.leading_day("s"), s="soon") == ""
    assert one(spark, times.leading_day("s"), s=None) == ""
    assert one(spark, times.day_stamp("s"), s="2018-05-03") == "2018-05-03T00:00:00Z"


@pytest.mark.parametrize("period,day,want", [
    ("daily", 3, "2018-05-03"), ("weekly", 3, "2018-04-29"), ("weekly", 6, "2018-05-06"), ("weekly", 5, "2018-04-29"),
    ("monthly", 31, "2018-05-01"),
])
def test_period_starts(spark, period, day, want):
    at = dt.datetime(2018, 5, day, 12)
    assert str(one(spark, times.period_start("t", period), t=at)) == want + " 00:00:00"
    assert str(one(spark, times.period_start_day("s", period), s=at.date().isoformat())) == want
    assert times.period_days(at.date().isoformat(), period)[0] == want


def test_unknown_period():
    with pytest.raises(ValueError):
        times.period_tag("hourly")


@pytest.mark.parametrize("day,want", [
    ("2019-11-28", False),  # 4th Thursday of November
    ("2019-11-22", False),  # 4th Friday, here a week before the day after Thanksgiving
    ("2019-11-29", True),
    ("2019-11-11", True), ("2019-05-27", False), ("2019-05-20", True), ("2019-09-02", False), ("2019-09-09", True),
    ("2019-01-21", True), ("2019-02-18", True), ("2019-07-04", False), ("2019-12-24", False), ("2019-12-25", False),
    ("2019-01-01", False), ("2019-01-05", False), ("2019-01-06", False), ("2019-01-07", True),
])
def test_business_days(spark, day, want):
    assert one(spark, times.is_business_day("s"), s=day) is want
    assert times.business_day(day) is want


def test_business_days_agree_over_years(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2015-01-01', DATE'2025-12-31')) AS d")
    rows = days.select(F.date_format("d", "yyyy-MM-dd").alias("d"), times.is_business_day("d").alias("b")).collect()
    assert all(times.business_day(r.d) == r.b for r in rows)


def test_series(spark):
    between = one(spark, times.days_between(F.lit("2020-02-27"), F.lit("2020-03-01")))
    assert [str(d) for d in between] == ["2020-02-27", "2020-02-28", "2020-02-29", "2020-03-01"]
    assert one(spark, times.days_between(F.lit("2020-03-02"), F.lit("2020-03-01"))) == []
    for period, n in (("daily", 1), ("weekly", 7), ("monthly", 29)):
        days = one(spark, times.days_of_period(F.lit("2020-02-10"), period))
        assert len(days) == n and [d.isoformat() for d in days] == times.period_days("2020-02-10", period)
    assert times.period_starts("2018-05-03", "2018-05-13", "weekly") == ["2018-04-29", "2018-05-06", "2018-05-13"]


def test_relative_days():
    assert times.relative_day("-1 days", "2018-03-01") == "2018-02-28"
    assert times.relative_day("2 days", "2018-03-01") == "2018-03-03"
    assert times.relative_day("2018-03-09", "2018-03-01") == "2018-03-09"
    assert times.relative_day("0 days") == dt.datetime.now(dt.timezone.utc).date().isoformat()
