"""Progress records of running streams."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class ProgressRecords(StreamingQueryListener):
    """Hands a JSON text to `emit` when a stream starts, makes progress, idles or ends."""

    def __init__(self, emit: Callable[[str], None]):
        self._emit = emit

    def _record(self, kind: str, **fields) -> None:
        self._emit(json.dumps({"event": kind, **fields}))

    def onQueryStarted(self, event) -> None:
        self._record("started", id=str(event.id), runId=str(event.runId), name=event.name, timestamp=event.timestamp)

    def onQueryProgress(self, event) -> None:
        self._record("progress", **{"progress": json.loads(event.progress.json)})

    def onQueryIdle(self, event) -> None:
        self._record("idle", id=str(event.id), runId=str(event.runId), timestamp=event.timestamp)

    def onQueryTerminated(self, event) -> None:
        self._record("terminated", id=str(event.id), runId=str(event.runId), exception=event.exception)


def watch(spark: SparkSession, emit: Callable[[str], None]) -> ProgressRecords:
    listener = ProgressRecords(emit)
    spark.streams.addListener(listener)
    return listener
