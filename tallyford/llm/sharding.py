"""Shards of near-equal size by histogram sort, in DataFrame operations only.

Rows are ordered by a hash of their text, then of their id, so that equal texts stand together. Shard boundaries are splitters
in that order: boundary i of n should have i / n of all bytes below it. They are found by histograms: every open
boundary has a key interval, evenly spaced probes cut it into bins, one pass counts the exact bytes of each bin over all
partitions, and the bin that holds the boundary's byte becomes the next interval. When a bin is down to one text
hash, its two edges are exact. The nearer edge is the boundary if it lies within `tolerance` (a share of a mean shard)
of its byte, so that equal texts stay together; a group too large for that is searched further by id hash, to the row. Only
one row per boundary comes to the driver in a round. With all splitters known the rows are exchanged once.

A row's place in its shard needs no task per shard: rows are counted by (shard, bin of text hash, bin of id hash), both of
fixed number, and only these counts are summed up ahead; rows are numbered within such a cell, in the exchange that brings
them there. So slots follow the text hash's first 12 bits, the id hash's first 10, then both hashes.

A null text has no bytes and checksum 0; an empty text likewise. Null ids hash alike and come first among equal texts. Rows with
equal id and text are told apart by their place in the input, each gets a slot. All columns of the input are kept whatever
their names. Texts of any length count whole. An empty table gives no rows. With fewer rows than shards, or rows larger than
a shard, some shards are empty.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .registry import query, table
from .work import Work, result

SHARDS = 24
# A group of equal texts stays whole if its nearer edge is within this share of a mean shard from the ideal boundary.
TOLERANCE = 0.005
PROBES = 4096
# Bits of the text hash and of the id hash that name a cell.
TEXT_BITS, ID_BITS = 12, 10
HASH_DIGITS = 15
HASH_BITS = 4 * HASH_DIGITS

KEYS = ("text_hash", "id_hash", "tie")


def _hash(text: Column) -> Column:
    """60 bits of a text's MD5; null is 0."""
    return F.coalesce(F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("long"), F.lit(0).cast("long"))


def _keys(docs: DataFrame, id_col: str, text_col: str, overhead: int) -> DataFrame:
    text = F.col(f"`{text_col}`")
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + overhead).alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0).cast("long")).alias("text_crc32"),
        _hash(text.cast("string")).alias("text_hash"), _hash(F.col(f"`{id_col}`").cast("string")).alias("id_hash"),
        F.monotonically_increasing_id().alias("tie"))


def _among(open_: list[dict]) -> Column:
    """The number of the interval that a row is in, null outside of all. Intervals differ in key, or do not overlap."""
    found = F.lit(None).cast("int")
    for i, at in enumerate(open_):
        here = [F.col(k) == v for k, v in zip(KEYS, at["prefix"])]
        here.append(F.col(KEYS[len(at["prefix"])]).between(at["low"], at["high"]))
        found = F.when(functools.reduce(operator.and_, here), i).otherwise(found)
    return found


def _histogram(keys: DataFrame, open_: list[dict]) -> list[dict]:
    """For each goal, the bin of its interval's histogram that holds the goal's byte: exact bytes below and in it, and its key range."""
    inside = keys.select(*KEYS, "size", _among(open_).alias("of")).where("of is not null")

    def by_interval(values) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("of") + 1)

    value = F.element_at(F.array(*[F.col(k) for k in KEYS]), by_interval([len(at["prefix"]) + 1 for at in open_]))
    probe = F.floor((value - by_interval([at["low"] for at in open_])) / by_interval([at["step"] for at in open_]))
    bins = inside.select("of", "size", value.alias("value"), probe.alias("bin")).groupBy("of", "bin").agg(
        F.sum("size").alias("bytes"), F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("rows"))
    order = Window.partitionBy("of").orderBy("bin")
    # A goal is a boundary's byte times the number of shards; one row for each goal.
    below = bins.withColumn("before", F.sum("bytes").over(order) - F.col("bytes") + by_interval([at["before"] for at in open_]))
    lists = F.array(*[F.array(*[F.lit(v).cast("long") for v in at["goals"]]) for at in open_])
    goals = F.explode(F.element_at(lists, F.col("of") + 1))
    shards = F.lit(open_[0]["shards"])
    held = below.withColumn("goal", goals).where(
        (F.col("before") * shards < F.col("goal")) & (F.col("goal") <= (F.col("before") + F.col("bytes")) * shards))
    return [r.asDict() for r in held.collect()]


def splitters(keys: DataFrame, shards: int, tolerance: float) -> list[tuple[int, ...]]:
    """The first key of each shard from the second on: `(text_hash,)` at a group's edge, else with `id_hash` and `tie`.

    `keys` has the columns of `KEYS` and `size`. Equal splitters leave the shards between them empty.
    """
    total = keys.agg(F.sum("size").alias("size")).first()["size"] or 0
    if not total:
        return []
    slack = total * tolerance  # times shards, like goals
    found: dict[int, tuple[int, ...]] = {}
    whole = {"prefix": (), "low": 0, "high": (1 << HASH_BITS) - 1, "before": 0, "goals": [total * i for i in range(1, shards)]}
    open_ = [whole]
    while open_:
        for at in open_:
            at["step"], at["shards"] = (at["high"] - at["low"]) // PROBES + 1, shards
        following: dict[tuple, dict] = {}
        for hit in _histogram(keys, open_):
            at, goal = open_[hit["of"]], hit["goal"]
            prefix, low, high = at["prefix"], hit["low"], hit["high"]
            start, end = hit["before"] * shards, (hit["before"] + hit["bytes"]) * shards
            single = hit["rows"] == 1 or len(prefix) + 1 == len(KEYS) and low == high
            near = not prefix and min(goal - start, end - goal) <= slack
            if low == high and (single or near):
                # Below the bin or above it, whichever edge is nearer.
                found[goal] = (*prefix, low) if goal - start < end - goal else (*prefix, low + 1)
                continue
            if low == high:
                prefix, low, high = (*prefix, low), 0, (1 << 63) - 1 if len(prefix) + 2 == len(KEYS) else (1 << HASH_BITS) - 1
            into = following.setdefault((prefix, low, high), {"prefix": prefix, "low": low, "high": high, "before": hit["before"], "goals": []})
            into["goals"].append(goal)
        open_ = list(following.values())
    return [found[goal] for goal in whole["goals"]]


def _at_or_above(splitter: tuple[int, ...]) -> Column:
    here = F.col(KEYS[len(splitter) - 1]) >= splitter[-1]
    for k, v in reversed(list(zip(KEYS, splitter[:-1]))):
        here = (F.col(k) > v) | ((F.col(k) == v) & here)
    return here


def sharded(
    docs: DataFrame, work: Work, shards: int = SHARDS, *, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8,
    tolerance: float = TOLERANCE, keep: list[str] | None = None,
) -> DataFrame:
    """`(row, size, text_crc32, shard, slot)`: `row` has the columns `keep` of the document, all if not given."""
    rows = _keys(docs, id_col, text_col, overhead)
    if keep is not None:
        rows = rows.withColumn("row", F.struct(*[F.col("row").getField(c).alias(c) for c in keep]))
    rows = work.keep(rows, "keys")
    above = [_at_or_above(s).cast("int") for s in splitters(rows, shards, tolerance)]
    dealt = rows.withColumns({
        "shard": functools.reduce(operator.add, above, F.lit(0)),
        "text_bin": F.shiftright("text_hash", HASH_BITS - TEXT_BITS).cast("int"),
        "id_bin": F.shiftright("id_hash", HASH_BITS - ID_BITS).cast("int")})
    cell, zero = ["shard", "text_bin", "id_bin"], F.lit(0).cast("long")

    def ahead(df: DataFrame, group: list[str], by: str, name: str) -> DataFrame:
        window = Window.partitionBy(*group).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return df.select(*group, by, F.coalesce(F.sum("n").over(window), zero).alias(name))

    counts = work.keep(dealt.groupBy(*cell).agg(F.count("*").alias("n")), "cells")
    bins = counts.groupBy("shard", "text_bin").agg(F.sum("n").alias("n"))
    first = ahead(counts, ["shard", "text_bin"], "id_bin", "in_bin").join(ahead(bins, ["shard"], "text_bin", "in_shard"), ["shard", "text_bin"])
    within = F.row_number().over(Window.partitionBy(*cell).orderBy(*KEYS))
    return dealt.withColumn("within", within).join(first, cell).select(
        "row", "size", "text_crc32", "shard", (F.col("within") - 1 + F.col("in_bin") + F.col("in_shard")).alias("slot"))


def write_shards(docs: DataFrame, path: str, work: Work, shards: int = SHARDS, **options) -> None:
    """Parquet files below `shard=<number>` folders; a shard of any size is written by as many tasks as it has parts."""
    made = sharded(docs, work, shards, **options).select("row.*", F.col("shard").alias("shard_"), "slot")
    made.hint("rebalance", "shard_").withColumnRenamed("shard_", "shard").write.partitionBy("shard").parquet(path)


SQL = rf"""
WITH crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda r, x: xor(r // 2, 3988292384 * (r % 2))) AS c FROM (SELECT unnest(range(256)) AS b))),
keyed AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT + 8 AS size, hex(encode(coalesce(text, ''))) AS h,
         coalesce(('0x' || substr(md5(text), 1, {HASH_DIGITS}))::BIGINT, 0) AS k,
         coalesce(('0x' || substr(md5(doc_id::VARCHAR), 1, {HASH_DIGITS}))::BIGINT, 0) AS j FROM documents),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY k, j, doc_id ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total FROM keyed),
grouped AS (SELECT *, min(before) OVER g AS low, max(before + size) OVER g AS high FROM placed WINDOW g AS (PARTITION BY k)),
goals AS (SELECT unnest(range(1, {SHARDS})) AS i),
cuts AS (
  SELECT i, CASE WHEN least(i * total - low * {SHARDS}, high * {SHARDS} - i * total) <= total * {TOLERANCE}::DOUBLE THEN
              CASE WHEN i * total - low * {SHARDS} < high * {SHARDS} - i * total THEN low ELSE high END
            ELSE CASE WHEN i * total - before * {SHARDS} < (before + size) * {SHARDS} - i * total THEN before ELSE before + size END END AS cut
  FROM goals JOIN grouped ON before * {SHARDS} < i * total AND i * total <= (before + size) * {SHARDS}),
dealt AS (SELECT g.*, (SELECT count(*) FROM cuts WHERE cut <= g.before)::INTEGER AS shard FROM grouped g)
SELECT doc_id, size, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
         list_transform(range(0, length(h), 2), lambda p: ('0x' || substr(h, p + 1, 2))::BIGINT)),
         lambda r, b: xor(r // 256, t[xor(r % 256, b) + 1]))) AS text_crc32,
       'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY k >> {HASH_BITS - TEXT_BITS}, j >> {HASH_BITS - ID_BITS}, k, j, doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM dealt, crc_table
"""


@query("op13_sharding", SQL)
def op13(spark, sf_dir):
    with Work(spark, "op13") as work:
        made = sharded(table(spark, sf_dir, "documents"), work, keep=["doc_id"])
        return result(made.select(
            F.col("row.doc_id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
            F.lit(None).cast("int").alias("grown_shard")))
