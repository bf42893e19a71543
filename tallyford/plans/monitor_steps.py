"""The monitors as job steps: each takes the stage's frame and yields messages for a sink, or the monitored rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..functions.times import add_days
from ..monitors import call_volume, common, devices, licences, tables, volume

# Shares of the average below which a day is off, where a step names none.
VOLUME_THRESHOLD, DEVICE_THRESHOLD = 0.5, 0.5


@dataclass
class Monitors:
    """The organisations that the monitors watch, and the region their table sums are tagged with."""

    orgs: Sequence[str]
    region: str | None = None


def monitor_steps(monitors: Monitors, run_day: Callable[[], str | None]) -> dict[str, Callable[[DataFrame, Mapping], DataFrame]]:
    """Transforms for `Job`. Parameters of all: `date`, the monitored day (the day before the run unless named), and `rows`, true for the
    monitored rows instead of their messages; where a monitor has them, `threshold`, `orgId`, `relation` and `orgNum`.

    The call volume monitor is two steps: `callVolumeModel` ends in a table, and `callVolumeMonitor` takes a frame of calls and
    the model's frame, set aside by `callVolumeView`.
    """
    orgs, region = list(monitors.orgs), monitors.region
    aside: dict[str, DataFrame] = {}

    def day(p: Mapping) -> str:
        return common.monitored_day(p.get("date"), run_day())

    def step(rows: Callable[[DataFrame, str, Mapping], DataFrame], messages: Callable[[DataFrame], DataFrame]):
        def run(df: DataFrame, p: Mapping) -> DataFrame:
            found = rows(df, day(p), p)
            return found if p.get("rows") else messages(found)

        return run

    def devices_of(alert: bool):
        pick = devices.anomalies if alert else devices.normal_rows
        return step(
            lambda df, on, p: pick(devices.run(df, orgs, on), float(p.get("threshold", DEVICE_THRESHOLD))),
            lambda rows: devices.messages(rows, alert))

    def keep_model(df: DataFrame, p: Mapping) -> DataFrame:
        aside["model"] = df
        return df.limit(0).select()

    def call_alerts(df: DataFrame, on: str, p: Mapping) -> DataFrame:
        if "model" not in aside:
            raise ValueError("no step has set a call volume model aside")
        return call_volume.alerts(
            df, aside["model"], on, float(p.get("threshold", call_volume.THRESHOLD)), p.get("eventTime", ""),
            int(p.get("orgNum", call_volume.TOP_ORGS)))

    return {
        "volumeMonitor": step(
            lambda df, on, p: volume.run(df, orgs, on, float(p.get("threshold", VOLUME_THRESHOLD)), p.get("orgId", "*")),
            volume.messages),
        "licenseMonitor": step(lambda df, on, p: licences.run(df, orgs, on), licences.messages),
        "deviceUsageMonitor": devices_of(True),
        "deviceUsageReport": devices_of(False),
        "dataTableMonitor": step(
            lambda df, on, p: tables.data_sums(df, orgs, on, region, p.get("relation", tuple(tables.DATA_RELATIONS))),
            lambda rows: tables.table_messages(rows, "pdate")),
        "aggTableMonitor": step(
            lambda df, on, p: tables.aggregate_sums(df, orgs, on, region, p.get("relation", tuple(tables.AGG_RELATIONS))),
            lambda rows: tables.table_messages(rows, "time_stamp")),
        "durationMonitor": step(
            lambda df, on, p: tables.daily_duration(df, orgs, on), lambda rows: tables.daily_messages(rows, "BCDuration")),
        "qualityMonitor": step(
            lambda df, on, p: tables.daily_quality(df, orgs, on), lambda rows: tables.daily_messages(rows, "BCQuality")),
        "callVolumeModel": lambda df, p: call_volume.model(
            df, add_days(day(p), 1), int(p.get("days", call_volume.HISTORY_DAYS)), int(p.get("orgNum", call_volume.TOP_ORGS))),
        "callVolumeView": keep_model,
        "callVolumeMonitor": step(call_alerts, call_volume.messages),
    }
