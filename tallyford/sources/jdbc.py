"""JDBC sources and sinks."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession

from ..operators.keyed import last_write
from ..operators.shaping import drop_empty_rows, lower_names
from .modes import save_mode

COMMIT_ROWS = 5000
CONNECTIONS = 10


def read_options(settings: Mapping[str, str], partition: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of a table or query read; `partition` names column, bounds and number of slices."""
    names = {"url": "url", "driver": "driver", "username": "user", "password": "password"}
    options = {option: settings[name] for name, option in names.items() if name in settings}
    if "query" in settings:
        if partition:
            options["dbtable"] = f"({settings['query']}) q"
        else:
            options["query"] = settings["query"]
    else:
        options["dbtable"] = settings["dbtable"]
    if partition:
        options.update({
            "partitionColumn": partition["column"], "lowerBound": str(partition["lower"]),
            "upperBound": str(partition["upper"]), "numPartitions": str(partition["slices"])})
    return options


def read_jdbc(spark: SparkSession, settings: Mapping[str, str], partition: Mapping | None = None,
              streaming: bool = False) -> DataFrame:
    if streaming:
        raise ValueError("JDBC tables cannot be read as a stream")
    return spark.read.format("jdbc").options(**read_options(settings, partition)).load()


def write_jdbc(df: DataFrame, settings: Mapping[str, str], mode: str) -> None:
    """Plain write, columns in lower case."""
    options = read_options({k: v for k, v in settings.items() if k != "query"})
    lower_names(df.drop("raw")).write.format("jdbc").options(**options).mode(save_mode(mode)).save()


def upsert_statements(
    table: str, columns: Sequence[str], keys: Sequence[str], mark: str = "?", source: str = ""
) -> tuple[str, str]:
    """Prepared update (empty when every column is a key) and insert-if-missing.

    `source` is the FROM clause some databases want in a row-less select, such as `FROM dual`.
    """
    rest = [c for c in columns if c not in keys]
    matched = " AND ".join(f"{k} = {mark}" for k in keys)
    update = f"UPDATE {table} SET {', '.join(f'{c} = {mark}' for c in rest)} WHERE {matched}" if rest else ""
    insert = (
        f"INSERT INTO {table} ({', '.join(columns)}) SELECT {', '.join(mark for _ in columns)} {source} "
        f"WHERE NOT EXISTS (SELECT 1 FROM {table} WHERE {matched})")
    return update, insert


def upsert_jdbc(
    df: DataFrame, connect: Callable[[], object], table: str, keys: Sequence[str], order: Column | None = None,
    commit_rows: int = COMMIT_ROWS, connections: int = CONNECTIONS, mark: str = "?", source: str = "",
) -> None:
    """Update-else-insert by key, in batches of `commit_rows` per commit.

    `connect` opens a DB-API connection inside the task. One row per key is left before writing, so
    tasks never race on a key, and the rows are hashed over a fixed number of connections; repeating
    a failed task's batch writes the same values again.
    """
    rows = drop_empty_rows(lower_names(df.drop("raw")))
    keys = [k.lower() for k in keys]
    columns = rows.columns
    update, insert = upsert_statements(table, columns, keys, mark, source)
    rest = [c for c in columns if c not in keys]

    def write(part: Iterator[Row]) -> None:
        connection = None
        try:
            while batch := list(itertools.islice(part, commit_rows)):
                if connection is None:
                    connection = connect()
                cursor = connection.cursor()
                if update:
                    cursor.executemany(update, [[r[c] for c in (*rest, *keys)] for r in batch])
                cursor.executemany(insert, [[r[c] for c in (*columns, *keys)] for r in batch])
                connection.commit()
        finally:
            if connection is not None:
                connection.close()

    last_write(rows, keys, order).repartition(connections, *keys).foreachPartition(write)
