"""The reports as job steps, under the names jobs call them by."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sql_names
from ..operators import shaping
from ..reports import calls, content, devices, keys, licences, regions, usage


# Steps that set a frame aside under a name, and the columns kept.
VIEWS = {"activeUserView": ("activeUser", ["orgId", "pdate"]), "regionMapView": ("regionMap", ["orgId", "region"])}


@dataclass
class Lookups:
    """The lists and mappings the reports join with, and the names that differ between installations.

    `room_device_prefix` has no default: without the right one meetings of room systems would count as users.
    """

    excluded_orgs: DataFrame
    test_users: DataFrame
    agents: DataFrame
    endpoints: DataFrame
    regions: DataFrame | None = None
    tracking_id: str = "trackingId"
    room_device_prefix: str = field(kw_only=True)
    clients: DataFrame | None = field(default=None, kw_only=True)
    onboard_methods: DataFrame | None = field(default=None, kw_only=True)
    license_types: DataFrame | None = field(default=None, kw_only=True)


def register_lookups(spark: SparkSession, lookups: Lookups) -> None:
    """The lists and mappings as functions of SQL texts."""
    sql_names.register_excluded_orgs(spark, lookups.excluded_orgs)
    sql_names.register_test_users(spark, lookups.test_users)
    mappings = {"uaCategory": lookups.agents, "ep1": lookups.endpoints, "clientMapping": lookups.clients,
                "onboardMethodMapping": lookups.onboard_methods, "licenseMapping": lookups.license_types}
    for name, mapping in mappings.items():
        if mapping is not None:
            sql_names.register_mapping(spark, name, mapping)


def split_data(df: DataFrame, p: Mapping) -> DataFrame:
    """Lines of one application, or of one feature when a feature is named."""
    if "featureName" in p:
        return shaping.route(df, p["featureName"], "featureName")
    return shaping.route(df, p["appName"])


def report_steps(lookups: Lookups) -> dict[str, Callable[[DataFrame, Mapping], DataFrame]]:
    """Transforms for `Job`: each takes the stage's frame and parameters; counts need `aggregatePeriod`."""
    orgs = lookups.excluded_orgs

    def counted(report: Callable[..., DataFrame], *more) -> Callable[[DataFrame, Mapping], DataFrame]:
        return lambda df, p: report(df, *more, p["aggregatePeriod"])

    def plain(report: Callable[..., DataFrame], *more) -> Callable[[DataFrame, Mapping], DataFrame]:
        return lambda df, p: report(df, *more)

    steps = {
        "activeUser": lambda df, p: usage.active_users(
            df, orgs, lookups.test_users, lookups.agents, lookups.tracking_id,
            room_device_prefix=lookups.room_device_prefix),
        "activeUserCount": counted(usage.active_user_count),
        "oneToOneCount": counted(usage.one_to_one_count),
        "spaceCount": counted(usage.space_count),
        "activeUserRollUp": plain(usage.user_day_rollup),
        "rtUser": plain(usage.room_users),
        "topUser": counted(usage.top_users),
        "callDuration": plain(calls.call_duration, orgs),
        "callDurationCount": counted(calls.call_minutes, lookups.endpoints),
        "totalCallCount": counted(calls.total_calls, lookups.endpoints),
        "callQuality": plain(calls.call_quality, orgs),
        "callQualityBadCount": counted(calls.bad_calls),
        "callQualityTotalCount": counted(calls.all_calls),
        "topPoorQuality": counted(calls.top_poor_quality),
        "fileUsed": plain(content.files_used, orgs),
        "fileUsedCount": counted(content.file_count),
        "registeredEndpoint": plain(devices.registered_endpoints, orgs),
        "registeredEndpointCount": counted(devices.endpoint_count),
        "autoLicense": plain(licences.auto_licences),
        "splitData": split_data,
        "selectDataToDeleteFromCassandra": plain(keys.keys_to_delete),
    }
    return steps | region_steps(lookups.regions)


def region_steps(mapping: DataFrame | None) -> dict[str, Callable[[DataFrame, Mapping], DataFrame]]:
    """Users by region. Users are the step's input or, where it has none, what `activeUserView` has set aside; the
    regions are those of the lookups or what `regionMapView` has set aside."""
    aside: dict[str, DataFrame] = {}

    def view(step: str) -> Callable[[DataFrame, Mapping], DataFrame]:
        name, columns = VIEWS[step]

        def run(df: DataFrame, p: Mapping) -> DataFrame:
            aside[name] = df.select(columns)
            aside[name].createOrReplaceTempView(name)
            return df.limit(0).select()

        return run

    def named(name: str) -> DataFrame:
        if name not in aside:
            raise ValueError(f"no step has set {name} aside")
        return aside[name]

    def report(make: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[DataFrame, Mapping], DataFrame]:
        def run(df: DataFrame | None, p: Mapping) -> DataFrame:
            users = df if df is not None and df.columns else named("activeUser")
            known = mapping if mapping is not None else named("regionMap")
            return make(users, known.where(F.col("region").isNotNull()))

        return run

    return {step: view(step) for step in VIEWS} | {
        "activeUserEU": report(regions.in_region), "activeUserUS": report(regions.outside_region),
        "orgIdNoRegion": report(regions.without_region)}
