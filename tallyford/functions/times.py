"""Time, calendar and period expressions (the session zone is UTC)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted time texts, day and minute formats, watermark delays per period.
STAMP_PATTERNS = ("yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
DAY = "yyyy-MM-dd"
MINUTE = "yyyy-MM-dd HH:mm"
WATERMARK_DELAY = {"daily": "28 hours", "weekly": "8 days", "monthly": "32 days"}
# Days off. 1 = Sunday ... 7 = Saturday; holidays by date, and by month, weekday and the
# first and last day of the month they can fall on.
WEEKEND = [1, 7]
HOLIDAY_DATES = ["01-01", "07-04", "12-24", "12-25"]
HOLIDAY_WEEKDAYS = [(5, 2, 25, 31), (9, 2, 1, 7), (11, 5, 22, 28), (11, 6, 22, 28)]


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def check_period(period: str) -> str:
    if period not in WATERMARK_DELAY:
        raise ValueError(f"period must be one of {sorted(WATERMARK_DELAY)}, not {period!r}")
    return period


def iso_day(ts: Column | str) -> Column:
    """Time to `yyyy-MM-dd`; null stays null."""
    return F.date_format(as_column(ts), DAY)


def iso_minute(ts: Column | str) -> Column:
    """Time to `yyyy-MM-dd HH:mm`."""
    return F.date_format(as_column(ts), MINUTE)


# A time text with a time of day; Spark's own parser reads all of these.
STAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})?$"


def is_stamp(text: Column | str) -> Column:
    return F.rlike(as_column(text), F.lit(STAMP))


def is_day_only(text: Column | str) -> Column:
    """Whether only the leading date of a text is read, because the rest is in no known form."""
    text = as_column(text)
    rest = ~is_stamp(text) | F.try_to_timestamp(text).isNull()
    return (F.length(text) > 10) & rest & F.try_to_timestamp(F.substring(text, 1, 10), F.lit(DAY)).isNotNull()


def parse_stamp(text: Column | str, on_error: str = "null") -> Column:
    """Time text to a timestamp; the leading date counts when the rest is in no known form.

    Seconds may have a fraction of any length, `T` or a blank may stand before the time, and `Z`, an offset or nothing
    after it. Unreadable text gives null, or the current time with `on_error='now'`.
    """
    text = as_column(text)
    exact = F.when(is_stamp(text), F.try_to_timestamp(text))
    tries = [exact, F.try_to_timestamp(F.substring(text, 1, 10), F.lit(DAY))]
    if on_error == "now":
        tries.append(F.current_timestamp())
    elif on_error != "null":
        raise ValueError("on_error must be 'null' or 'now'")
    return F.coalesce(*tries)


def text_day(text: Column | str, on_error: str = "null") -> Column:
    """Time text to `yyyy-MM-dd`."""
    return iso_day(parse_stamp(text, on_error))


def end_of_day(ts: Column | str) -> Column:
    """The last second of the day."""
    return F.date_trunc("day", as_column(ts)) + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 1 SECOND")


def period_start(ts: Column | str, period: str) -> Column:
    """Start of the day, of the week (Sunday) or of the month, as a timestamp."""
    ts = as_column(ts)
    check_period(period)
    if period == "daily":
        return F.date_trunc("day", ts)
    if period == "monthly":
        return F.date_trunc("month", ts)
    return period_start_day(ts, period).cast("timestamp")


def period_start_day(day: Column | str, period: str) -> Column:
    """Start of the period a day lies in, as a date."""
    day = as_column(day).try_cast("date")
    check_period(period)
    if period == "weekly":
        return F.date_sub(day, F.dayofweek(day) - 1)
    if period == "monthly":
        return F.trunc(day, "month")
    return day


def period_tag(period: str) -> Column:
    return F.lit(check_period(period))


def unix_day(seconds: Column | str) -> Column:
    """Unix seconds to `yyyy-MM-dd`."""
    return F.from_unixtime(as_column(seconds), DAY)


def leading_day(text: Column | str) -> Column:
    """The date a text starts with, `''` when there is none."""
    day = F.try_to_timestamp(F.substring(as_column(text), 1, 10), F.lit(DAY))
    return F.coalesce(iso_day(day), F.lit(""))


def is_business_day(day: Column | str) -> Column:
    """False on weekends and on the fixed holidays, true on all other days."""
    day = as_column(day).try_cast("date")
    weekday, month, dom = F.dayofweek(day), F.month(day), F.dayofmonth(day)
    off = weekday.isin(WEEKEND) | F.date_format(day, "MM-dd").isin(HOLIDAY_DATES)
    for m, w, first, last in HOLIDAY_WEEKDAYS:
        off = off | ((month == m) & (weekday == w) & dom.between(first, last))
    return ~off


def business_day(day: str) -> bool:
    """`is_business_day` of one date, for filters that list their dates."""
    date = dt.date.fromisoformat(day)
    weekday = date.isoweekday() % 7 + 1
    return not (
        weekday in WEEKEND or day[5:10] in HOLIDAY_DATES
        or any(date.month == m and weekday == w and first <= date.day <= last
               for m, w, first, last in HOLIDAY_WEEKDAYS))


def days_between(start: Column | str, end: Column | str) -> Column:
    """All dates from start to end, both included; empty when start is after end."""
    start, end = as_column(start).try_cast("date"), as_column(end).try_cast("date")
    days = F.sequence(start, end, F.expr("INTERVAL 1 DAY"))
    return F.when(start <= end, days).otherwise(F.array().cast("array<date>"))


def days_of_period(day: Column | str, period: str) -> Column:
    """All dates of the period a day lies in."""
    start = period_start_day(day, period)
    last = {"daily": start, "weekly": F.date_add(start, 6), "monthly": F.last_day(start)}[period]
    return days_between(start, last)


def day_stamp(day: Column | str) -> Column:
    """Date to `yyyy-MM-ddT00:00:00Z`."""
    return F.date_format(as_column(day).try_cast("timestamp"), STAMP_PATTERNS[0])


def relative_day(spec: str, run_day: str | None = None) -> str:
    """A date text as it is, or `"-1 days"` counted from the run day (today when unset)."""
    if "days" not in spec:
        return spec
    base = dt.date.fromisoformat(run_day) if run_day else dt.datetime.now(dt.timezone.utc).date()
    return (base + dt.timedelta(days=int("".join(spec.replace("days", "").split())))).isoformat()


def add_days(day: str, n: int) -> str:
    return (dt.date.fromisoformat(day) + dt.timedelta(days=n)).isoformat()


def period_days(day: str, period: str | None) -> list[str]:
    """The dates of the period around one date, for building paths of dated folders."""
    start = dt.date.fromisoformat(day)
    length = 1
    if period == "weekly":
        start -= dt.timedelta(days=start.isoweekday() % 7)
        length = 7
    elif period == "monthly":
        start = start.replace(day=1)
        length = ((start + dt.timedelta(days=31)).replace(day=1) - start).days
    return [(start + dt.timedelta(days=i)).isoformat() for i in range(length)]


def period_starts(start: str, end: str, period: str) -> list[str]:
    """The distinct period starts of a date range, in order."""
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    days = ((first + dt.timedelta(days=i)).isoformat() for i in range((last - first).days + 1))
    return sorted({period_days(d, period)[0] for d in days})
