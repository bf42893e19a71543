"""Jobs: stages of named steps, composed into DataFrames.

A job is data: a list of stages, each a list of steps `{"queryName", "parameters", "disable",
"dateRange"}`. Running it builds lazy DataFrames; only sinks start Spark jobs.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions import sql_names
from ..functions.times import period_starts, relative_day
from ..operators.shaping import normalize_time, schema_of_file, table_rows
from ..sinks import files as file_sinks
from ..sinks.tables import KeyedTable, insert_overwrite
from ..sources import files, jdbc, kafka, remote, tables
from ..sources.modes import save_mode
from ..streaming import sinks as streams
from .monitor_steps import Monitors, monitor_steps
from .sql_stage import sql_stage
from .steps import Lookups, register_lookups, report_steps

BATCH, STREAM = "batch", "stream"
# Fixed value: tables whose day is in their time column.
TIME_KEYED = ["spark_agg_v2"]
# Days lie within weeks, but weeks not within months.
PERIODS_BY_LENGTH = ["daily", "weekly", "monthly"]


@dataclass
class Job:
    """What the steps of a job share.

    `settings` holds defaults that a step's parameters override. `transforms` maps a step name to
    a function of (frame, parameters); `sql` maps it to SQL text. `tables` are keyed tables by name.
    With `lookups` the reports are steps, and SQL texts have the mapping and list functions. With `monitors` the monitors are
    steps; they look at the day before `run_day`.
    """

    spark: SparkSession
    mode: str = BATCH
    settings: dict = field(default_factory=dict)
    transforms: dict[str, Callable[[DataFrame, Mapping], DataFrame]] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)
    schemas: dict[str, StructType] = field(default_factory=dict)
    tables: dict[str, KeyedTable] = field(default_factory=dict)
    connections: dict[str, Callable] = field(default_factory=dict)
    lookups: Lookups | None = None
    monitors: Monitors | None = None
    run_day: str | None = None
    preview: int = 0
    _registered: bool = field(default=False, repr=False)

    def __post_init__(self):
        if self.mode not in (BATCH, STREAM):
            raise ValueError(f"mode must be {BATCH!r} or {STREAM!r}, not {self.mode!r}")
        if self.lookups:
            self.transforms = {**report_steps(self.lookups), **self.transforms}
        if self.monitors:
            self.transforms = {**monitor_steps(self.monitors, lambda: self.run_day), **self.transforms}

    def register_functions(self) -> None:
        """Make the scalar functions known to SQL texts, once."""
        if not self._registered:
            sql_names.register(self.spark)
            if self.lookups:
                register_lookups(self.spark, self.lookups)
            self._registered = True

    @property
    def streaming(self) -> bool:
        return self.mode == STREAM

    def schema(self, name: str | None, explicit: bool = False) -> StructType | None:
        """A schema by name: given, or read from the schema folder as JSON schema text or as a sample."""
        if name is None:
            return None
        if name not in self.schemas:
            path = f"{self.settings['schemaLocation'].rstrip('/')}/{name}.json"
            if explicit:
                self.schemas[name] = StructType.fromJson(json.loads(files.read_whole_text(self.spark, path)))
            else:
                self.schemas[name] = schema_of_file(self.spark, path)
        return self.schemas[name]

    def sql_text(self, name: str) -> str:
        if name not in self.sql:
            self.sql[name] = files.read_whole_text(self.spark, f"{self.settings['queryLocation'].rstrip('/')}/{name}")
        return self.sql[name]


@dataclass
class Result:
    """A frame with the step that made it, or the streaming query a sink started."""

    step: Mapping
    frame: DataFrame | None = None
    query: StreamingQuery | None = None


def merged(base: Mapping, over: Mapping) -> dict:
    """Nested dicts with the second's values on top."""
    out = dict(base)
    for key, value in over.items():
        out[key] = merged(out[key], value) if isinstance(value, Mapping) and isinstance(out.get(key), Mapping) else value
    return out


def inherited_output(parameters: Mapping) -> str | None:
    """The output name a step hands on: its own, with the aggregate period."""
    if not parameters.get("output"):
        return None
    period = parameters.get("aggregatePeriod")
    return parameters["output"] + (f"_{period}" if period else "")


def backfilled(step: Mapping) -> list[dict]:
    """A dated read as one step per period start of its date range.

    With `"oneScan": true` in the range it stays one step that reads all periods: right where the steps after it group by their
    `aggregatePeriod`, which must not be longer than the read's, so that no result spans two reads.
    """
    if step["queryName"] != "readFromFile" or "dateRange" not in step:
        return [dict(step)]
    parameters, dates = step["parameters"], step["dateRange"]
    starts = period_starts(dates["startDate"], dates["endDate"], parameters["period"])
    if dates.get("oneScan"):
        return [{**step, "parameters": {**parameters, "date": starts[0], "periodStarts": starts}}]
    return [{**step, "parameters": {**parameters, "date": day}} for day in starts]


def _read_file(job: Job, frame, p: Mapping):
    fmt, multiline = p["format"], p.get("multiline", False)
    schema = job.schema(p.get("schemaName"), explicit=fmt == "csv" and "date" in p)
    root, inputs = p["dataLocation"], p["input"]
    if "date" not in p:
        if job.streaming:
            return files.stream_files(job.spark, root, inputs, fmt, schema, multiline)
        return files.read_files(job.spark, root, inputs, fmt, schema, multiline)
    day = relative_day(p["date"], job.run_day)
    if job.streaming:
        return files.stream_period(job.spark, root, inputs, fmt, day, p.get("period"), p.get("partitionKey"),
                                   schema=schema, multiline=multiline)
    return files.read_period(
        job.spark, root, inputs, fmt, p.get("periodStarts", day), p.get("period"), p.get("partitionKey"), schema,
        p.get("enableBasePath", False), p.get("alias"), p.get("aliasColumn"), multiline, p.get("tabDelimited", False))


def _write_file(job: Job, frame: DataFrame, p: Mapping):
    path = f"{p['dataLocation'].rstrip('/')}/{p['output']}"
    if job.streaming:
        return streams.to_files(frame, path, p["format"], p["output"], p["saveMode"], p.get("partitionKey"),
                                _trigger(p), _checkpoints(p), _names(p.get("keys", "")))
    file_sinks.write_files(frame, path, p["format"], p["saveMode"], p.get("partitionKey"))


def _read_topic(job: Job, frame, p: Mapping):
    loss = p.get("spark", {}).get("streamingKafkaFailOnDataLoss")
    settings = p["kafka"] if loss is None else {"failOnDataLoss": loss, **p["kafka"]}
    return kafka.read_topics(job.spark, settings, job.streaming, job.schema(p.get("schemaName")))


def _write_topic(job: Job, frame: DataFrame, p: Mapping):
    topic = p["kafka"].get("topic") or p["output"]
    if job.streaming:
        return streams.to_topic(frame, {**p["kafka"], "topic": topic}, p.get("output", topic), "append",
                                _trigger(p), _checkpoints(p))
    kafka.write_topic(frame, p["kafka"], topic)


def _read_table(job: Job, frame, p: Mapping):
    if job.streaming:
        raise ValueError("a wide-column table cannot be read as a stream")
    name = p["cassandra"]["table"]
    table = job.tables.get(name)
    rows = table.read(job.spark) if table else tables.read_wide_table(job.spark, tables.wide_options(p["cassandra"]))
    day = relative_day(p["date"], job.run_day) if "date" in p else None
    return tables.select_rows(
        rows, day, p.get("relation"), p.get("month"), p.get("monthPartition", False), p.get("wholeMonth", False),
        p.get("dayColumn", "time_stamp" if name in TIME_KEYED else "pdate"))


def _write_table(job: Job, frame: DataFrame, p: Mapping):
    name = p["cassandra"]["table"]
    mode = p["cassandra"]["saveMode"]
    if name in job.tables:
        if job.streaming:
            return streams.to_keyed_table(frame, job.tables[name], p["output"], mode, _trigger(p), _checkpoints(p))
        save_mode(mode)
        return job.tables[name].upsert(frame)
    options = tables.wide_options(p["cassandra"])
    if job.streaming:
        def write(batch: DataFrame, _: int) -> None:
            table_rows(batch).write.format(tables.WIDE_COLUMN_FORMAT).options(**options).mode("append").save()

        return streams.each_batch(frame, write, f"sinkToCassandra_{p['output']}", mode, _trigger(p), _checkpoints(p))
    table_rows(frame).write.format(tables.WIDE_COLUMN_FORMAT).options(**options).mode(save_mode(mode)).save()


def _delete_rows(job: Job, frame: DataFrame, p: Mapping):
    if job.streaming:
        raise ValueError("rows cannot be deleted by a stream")
    name = p["cassandra"]["table"]
    if name not in job.tables:
        raise ValueError(f"{name!r} is not a keyed table of this job")
    job.tables[name].delete(frame)


def _write_hive(job: Job, frame: DataFrame, p: Mapping):
    if job.streaming:
        raise ValueError("a stream cannot insert into a table")
    hive = p["hive"]
    columns = [c.strip() for c in job.sql_text(hive["columns"]).split(",")]
    insert_overwrite(frame, hive["table"], columns, job.sql_text(hive["schema"]))


def _names(text: str) -> list[str]:
    return [k for k in "".join(text.split()).split(",") if k]


def _write_jdbc(job: Job, frame: DataFrame, p: Mapping):
    settings = p["oracle"]
    keys = _names(settings.get("pk", ""))
    if job.streaming:
        return streams.to_jdbc(frame, job.connections.get(settings["dbtable"]), settings["dbtable"], keys, p["output"],
                               settings.get("saveMode", "update"), _trigger(p), _checkpoints(p))
    if keys:
        return jdbc.upsert_jdbc(frame, job.connections[settings["dbtable"]], settings["dbtable"], keys)
    jdbc.write_jdbc(frame, settings, settings["saveMode"])


def _read_jdbc(job: Job, frame, p: Mapping):
    return jdbc.read_jdbc(job.spark, p["oracle"], p["oracle"].get("partition"), job.streaming)


def _enrich(job: Job, frame: DataFrame, p: Mapping):
    http = p["http"]
    return remote.enrich_in_batches(
        frame, job.connections.get("http") or remote.json_poster(f"{http['server']}/{http['endPoint']}"),
        job.schema(p.get("schemaName") or http["schemaName"]))


SOURCES = {
    "readFromFile": _read_file,
    "readFromKafka": _read_topic,
    "readFromCassandra": _read_table,
    "readFromOracle": _read_jdbc,
}
MIDDLES = {"readHttpRequest": _enrich}
SINKS = {
    "writeToFile": _write_file,
    "writeToKafka": _write_topic,
    "writeToCassandra": _write_table,
    "deleteFromCassandra": _delete_rows,
    "writeToHive": _write_hive,
    "writeToOracle": _write_jdbc,
}


def _trigger(p: Mapping) -> str | None:
    return p.get("trigger", p.get("spark", {}).get("streamngTriggerWindow", streams.TRIGGER))


def _checkpoints(p: Mapping) -> str | None:
    return p.get("spark", {}).get("streamingCheckpointLocation")


def run_step(job: Job, step: Mapping, before: Result | None) -> Result:
    """One step on the result before it (None for a root)."""
    name = step["queryName"]
    own = dict(step.get("parameters", {}))
    handed = inherited_output(before.step.get("parameters", {})) if before else None
    if handed:
        own["output"] = handed
    step = {**step, "parameters": own}
    parameters = merged(job.settings, own)
    frame = before.frame if before else None
    if name in SINKS:
        if frame is None:
            raise ValueError(f"{name} has no input")
        return Result(step, query=SINKS[name](job, frame, parameters))
    if name in SOURCES:
        out = SOURCES[name](job, frame, parameters)
    elif name in MIDDLES:
        if frame is None:
            raise ValueError(f"{name} has no input")
        out = MIDDLES[name](job, frame, parameters)
    elif name in job.transforms:
        out = job.transforms[name](frame, parameters)
    else:
        if "schemaName" in parameters:
            parameters["schema"] = job.schema(parameters["schemaName"])
        job.register_functions()
        out = sql_stage(job.spark, job.sql_text(name), frame, parameters, job.run_day)
    if out is not None and out.columns and "timeStampField" in own:
        out = normalize_time(out, own["timeStampField"], observation=own.get("observation"))
    if out is not None and job.preview and not job.streaming:
        out.show(job.preview, truncate=False)
    return Result(step, frame=out)


def check_one_scan(stages: list[list[Mapping]]) -> None:
    """Refuse periods that a backfill of one scan would not give as a read per period does."""
    read: str | None = None
    for stage in stages:
        steps = [s for s in stage if not s.get("disable")]
        if any(s["queryName"] in SOURCES for s in steps):
            read = next((s["parameters"]["period"] for s in steps if s.get("dateRange", {}).get("oneScan")), None)
        for step in steps:
            period = step.get("parameters", {}).get("aggregatePeriod")
            if read and period and PERIODS_BY_LENGTH.index(period) > PERIODS_BY_LENGTH.index(read):
                raise ValueError(f"{step['queryName']} groups by {period} what is read by {read}: read it {period} as well")


def run_plan(job: Job, stages: list[list[Mapping]]) -> list[Result]:
    """Feed every live result of a stage to every step of the next.

    A sink ends its branch; once no result is left, the next stage starts over from its sources.
    Returns the frames still live at the end and the streaming queries started. A batch frame that
    several steps consume is read again by each, with the columns and filters that step needs, unless the step that
    makes it has `"persist": true`; then it is kept until the plan ends.
    """
    check_one_scan(stages)
    live: list[Result] = []
    queries: list[Result] = []
    held: list[DataFrame] = []
    try:
        missing = False
        for stage in stages:
            steps = [s for step in stage if not step.get("disable") for s in backfilled(step)]
            if missing and not any(s["queryName"] in SOURCES for s in steps):
                continue
            if len(steps) > 1 and not job.streaming:
                held += [result.frame.persist() for result in live if result.step.get("persist")]
            results = [run_step(job, step, before) for before in (live or [None]) for step in steps]
            queries += [r for r in results if r.query is not None]
            live = [r for r in results if r.frame is not None]
            # Sources without data end their branches; later steps wait for the next source.
            missing = not live and any(s["queryName"] not in SINKS for s in steps)
    finally:
        for frame in held:
            frame.unpersist()
    return live + queries


def load_settings(spark: SparkSession, path: str) -> dict:
    """The defaults of a JSON settings file."""
    return json.loads(files.read_whole_text(spark, path))


def load_job(spark: SparkSession, path: str) -> list[list[dict]]:
    """The stages of a job file."""
    return json.loads(files.read_whole_text(spark, path))["queryPlan"]
