"""Enrichment of rows by a remote service."""

from __future__ import annotations

import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

BATCH_ROWS = 1000


def json_poster(url: str, timeout: float = 60.0) -> Callable[[str], str]:
    """A call that posts a JSON array and returns the response text."""

    def call(body: str) -> str:
        request = urllib.request.Request(url, body.encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=timeout) as reply:
            return reply.read().decode()

    return call


def enrich_in_batches(
    df: DataFrame, call: Callable[[str], str], schema: StructType | str, batch_rows: int = BATCH_ROWS
) -> DataFrame:
    """Send rows as JSON arrays, a bounded number at a time and from every task, and parse the replies.

    A reply is a JSON array of rows, which replace the input; one that is no such array fails the job. A call may be repeated when a task is
    retried, so the service has to be safe to call again.
    """
    if df.isStreaming:
        raise ValueError("a stream cannot be enriched by remote calls")

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch_rows):
                part = frame["value"].iloc[start:start + batch_rows]
                yield pd.DataFrame({"reply": [call("[" + ",".join(part) + "]")]}, dtype="object")

    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    replies = df.select(F.to_json(F.struct("*")).alias("value")).mapInPandas(ask, "reply string")
    parsed = F.from_json("reply", ArrayType(schema))
    return replies.select(F.inline(F.coalesce(parsed, F.raise_error(F.lit("a reply is no JSON array of rows")).cast(ArrayType(schema)))))
