"""The scalar functions under the names SQL texts call them by.

They are SQL functions: Spark inlines their bodies, so SQL text runs without Python and optimises
like the Column versions. Mapping and list functions become left joins on the named views.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .times import STAMP, check_period

_PARSE = (
    f"coalesce(CASE WHEN rlike({{0}}, '{STAMP.replace('{', '{{').replace('}', '}}')}') THEN try_to_timestamp({{0}}) END, "
    "try_to_timestamp(substring({0}, 1, 10), 'yyyy-MM-dd'))"
)
_REST = "to_json(map_filter(from_json(v, 'map<string,variant>'), (k, x) -> k NOT IN ('@message', 'SM')))"

# Name: (parameters, result type, body).
FUNCTIONS = {
    "convertTime": ("ts TIMESTAMP", "STRING", "date_format(ts, 'yyyy-MM-dd')"),
    "convertTimeToMinutePrecision": ("ts TIMESTAMP", "STRING", "date_format(ts, 'yyyy-MM-dd HH:mm')"),
    "convertTimeString": ("s STRING", "STRING", f"date_format({_PARSE.format('s')}, 'yyyy-MM-dd')"),
    "toTimestamp": ("s STRING", "TIMESTAMP", _PARSE.format("s")),
    "endOfDay": ("ts TIMESTAMP", "TIMESTAMP", "date_trunc('DAY', ts) + INTERVAL 1 DAY - INTERVAL 1 SECOND"),
    "unixDay": ("seconds BIGINT", "STRING", "from_unixtime(seconds, 'yyyy-MM-dd')"),
    "leadingDay": (
        "s STRING", "STRING",
        "coalesce(date_format(try_to_timestamp(substring(s, 1, 10), 'yyyy-MM-dd'), 'yyyy-MM-dd'), '')"),
    "shortUuid": (
        "s STRING", "STRING",
        "concat(substr(md5(s), 1, 8), '-', substr(md5(s), 9, 4), '-3', substr(md5(s), 14, 3), '-', "
        "substr('89ab', cast(conv(substr(md5(s), 17, 1), 16, 10) AS INT) % 4 + 1, 1), "
        "substr(md5(s), 18, 3), '-', substr(md5(s), 21, 12))"),
    "get_only_file_name": ("path STRING", "STRING", "substring_index(path, '/', -1)"),
    "calcAvgFromHistMin": (
        "h ARRAY<STRUCT<duration: BIGINT, max: BIGINT, min: BIGINT>>", "FLOAT",
        "cast(coalesce(try_divide(aggregate(h, 0L, (a, x) -> a + x.duration * (x.min + 1)), "
        "aggregate(h, 0L, (a, x) -> a + x.duration)), 0) AS FLOAT)"),
    "isBusinessDay": (
        "day STRING", "BOOLEAN",
        "NOT (dayofweek(try_cast(day AS DATE)) IN (1, 7) "
        "OR date_format(try_cast(day AS DATE), 'MM-dd') IN ('01-01', '07-04', '12-24', '12-25') "
        "OR (month(try_cast(day AS DATE)) = 9 AND dayofweek(try_cast(day AS DATE)) = 2 "
        "AND dayofmonth(try_cast(day AS DATE)) <= 7) "
        "OR (month(try_cast(day AS DATE)) = 11 AND dayofweek(try_cast(day AS DATE)) IN (5, 6) "
        "AND dayofmonth(try_cast(day AS DATE)) BETWEEN 22 AND 28) "
        "OR (month(try_cast(day AS DATE)) = 5 AND dayofweek(try_cast(day AS DATE)) = 2 "
        "AND dayofmonth(try_cast(day AS DATE)) > 24))"),
    "getTimestampField": (
        "v STRING", "STRING",
        "coalesce(get_json_object(v, '$.timeRcvd'), get_json_object(v, \"$['@timestamp']\"), '')"),
    "preprocess": (
        "v STRING", "STRING",
        "coalesce(CASE WHEN array_contains(json_object_keys(v), 'appname') THEN v "
        "WHEN instr(get_json_object(v, \"$['@message']\"), ':') > 0 THEN concat("
        f"regexp_replace(regexp_replace({_REST}, '^[{{][}}]$', '{{'), '[}}]$', ','), '\"SM\":', "
        "to_json(try_parse_json(trim(substr(get_json_object(v, \"$['@message']\"), "
        "instr(get_json_object(v, \"$['@message']\"), ':') + 1)))), '}') END, v)"),
}

PERIOD_BODIES = {
    "daily": "date_trunc('DAY', ts)",
    "weekly": "cast(date_sub(cast(ts AS DATE), dayofweek(ts) - 1) AS TIMESTAMP)",
    "monthly": "date_trunc('MONTH', ts)",
}

# Name: (parameters, key expression, default); the view has columns key and value.
MAPPINGS = {
    "uaCategory": ("ua STRING", "coalesce(ua, '')", "OTHER"),
    "ep1": ("device STRING, ua STRING", "concat(coalesce(device, ''), '|', coalesce(ua, ''))", "Other"),
    "clientMapping": ("client STRING", "coalesce(client, '')", "OTHER"),
    "onboardMethodMapping": ("method STRING", "coalesce(method, '')", "Unknown"),
    "licenseMapping": ("license STRING", "coalesce(license, '')", "Unknown"),
}


def _create(spark: SparkSession, name: str, parameters: str, result: str, body: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")


def register(spark: SparkSession) -> None:
    """Register the functions that need no tables."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        _create(spark, name, parameters, result, body)


def register_period(spark: SparkSession, period: str) -> None:
    """`aggregateStartDate` and `periodTag` of one period."""
    check_period(period)
    _create(spark, "aggregateStartDate", "ts TIMESTAMP", "TIMESTAMP", PERIOD_BODIES[period])
    _create(spark, "periodTag", "x STRING", "STRING", f"'{period}'")


def register_mapping(spark: SparkSession, name: str, mapping: DataFrame) -> None:
    """One of the mapping functions over a (key, value) table."""
    parameters, key, default = MAPPINGS[name]
    view = f"{name}_mapping"
    mapping.toDF("key", "value").createOrReplaceTempView(view)
    _create(spark, name, parameters, "STRING",
            f"coalesce((SELECT max(m.value) FROM {view} m WHERE m.key = {key}), '{default}')")


def register_excluded_orgs(spark: SparkSession, orgs: DataFrame) -> None:
    """`validOrg`: '1' for organisations of the list, else '0'."""
    orgs.toDF("org").createOrReplaceTempView("validOrg_list")
    _create(spark, "validOrg", "id STRING", "STRING",
            "CASE WHEN (SELECT max(l.org) FROM validOrg_list l WHERE l.org = id) IS NULL THEN '0' ELSE '1' END")


def register_test_users(spark: SparkSession, users: DataFrame) -> None:
    """`testUser`: 1 for users of the list, else 0."""
    users.toDF("user").createOrReplaceTempView("testUser_list")
    _create(spark, "testUser", "id STRING", "INT",
            "CASE WHEN (SELECT max(l.user) FROM testUser_list l WHERE l.user = id) IS NULL THEN 0 ELSE 1 END")


def register_tag_filter(spark: SparkSession, needles: Sequence[str]) -> None:
    """`appFilter`: whether a line contains any of the texts."""
    quoted = [n.replace("\\", "\\\\").replace("'", "\\'") for n in needles]
    body = " OR ".join(f"contains(line, '{n}')" for n in quoted)
    _create(spark, "appFilter", "line STRING", "BOOLEAN", body)
