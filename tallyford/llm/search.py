"""Ranked lexical search for a set of items by pipelined term partitioning.

The documents are cut into blocks of at most `BLOCK_DOCS` rows where they are read, and each block is inverted there: for every term that
an item may hold, the block's documents with their counts. A fixed-size filter of the items' terms, which only lets more
terms through as it fills, keeps other terms out early; the join with the items' terms is exact.

Terms are partitioned by document frequency into owners, rare terms first. A bundle is an item's sparse accumulator
for one block: document places and integer scores. Bundles travel from owner to owner: each stage co-groups the
bundles of (block, group of items) with the owner's lists for them, adds the contributions and hands the bundles on. A place leaves its
bundle only when its score and the most that later owners can add stay below the block's k-th best score so far, so
the k best are exact. After the last owner a bundle keeps its k best places, and the best over all blocks are ranked.

A group is never larger than a block's lists for `GROUP_ITEMS` items, however common a term is.

Null and empty texts hold no term: such documents count in no sum and such items find nothing. Texts may be of any length.
Repeated rows are documents, or items, of their own. Ids are integers; a null id ranks after others of its score. Other columns are
not read, whatever their names. Without documents or items there are no rows. Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .registry import query, table
from .sieve import passes, sieve
from .textscan import Texts, signed, slices
from .work import Work, result

BLOCK_DOCS = 8192
BLOCK_POSTINGS = 1 << 20
GROUP_ITEMS = 256
# Shares of the documents up to which the owners before the last take a term.
OWNERS = (0.01, 0.1)
FILTER_BITS = 20
# No term adds more than its weight times this.
MOST_SHARE = 1_000_000

BETWEEN = np.ones(256, bool)
BETWEEN[0x30:0x3A] = BETWEEN[0x41:0x5B] = BETWEEN[0x61:0x7B] = BETWEEN[0x80:] = False

LISTS = "block long, term long, docs array<int>, counts array<int>, lengths array<int>, ids array<long>"
BUNDLE = "block long, items long, item int, docs array<int>, scores array<long>"


def _list(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, kind))


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`(items, item, item_id, term)`: the distinct terms of each row, rows numbered within groups of `GROUP_ITEMS`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId() << 32, 0
        for batch in slices(batches):
            texts = Texts(batch.column("text"), space=BETWEEN)
            pairs = np.unique(np.stack([texts.text_of_word().astype(np.uint64), texts.words()]), axis=1)
            row = pairs[0].astype(np.int64)
            place = seen + row
            seen += texts.n
            yield pa.RecordBatch.from_arrays([
                pa.array(task + place // GROUP_ITEMS), pa.array((place % GROUP_ITEMS).astype(np.int32)),
                batch.column("id").take(pa.array(row)), pa.array(signed(pairs[1]))], names=["items", "item", "item_id", "term"])

    named = items.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return named.mapInArrow(run, "items long, item int, item_id long, term long")


class _Block:
    """Postings of the documents read so far, until they become a block's lists."""

    def __init__(self):
        self.ids, self.lengths, self.terms, self.docs, self.counts, self.rows, self.size = [], [], [], [], [], 0, 0

    def add(self, ids: pa.Array, texts: Texts, passed: np.ndarray) -> None:
        words, doc = texts.words(), texts.text_of_word()
        kept = passes(passed, words)
        words, doc = words[kept], doc[kept]
        order = np.lexsort((doc, words))
        words, doc = words[order], doc[order]
        new = np.ones(len(words), bool)
        new[1:] = (words[1:] != words[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        self.terms.append(words[at])
        self.docs.append(doc[at] + self.rows)
        self.counts.append(np.diff(np.append(at, len(words))))
        self.ids.append(ids)
        self.lengths.append(np.diff(texts.first))
        self.rows += texts.n
        self.size += len(at)

    def lists(self, block: int) -> pa.RecordBatch:
        """A row for each term, and one without a term that has the block's ids and lengths. Places ascend by id, null last."""
        ids, lengths = pa.concat_arrays(self.ids), np.concatenate(self.lengths)
        order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        place = np.empty(self.rows, np.int64)
        place[order] = np.arange(self.rows)
        terms, docs, counts = (np.concatenate(x) for x in (self.terms, self.docs, self.counts))
        by_term = np.lexsort((place[docs], terms))
        terms, docs, counts = terms[by_term], docs[by_term], counts[by_term]
        new = np.ones(len(terms), bool)
        new[1:] = terms[1:] != terms[:-1]
        starts = np.append(np.flatnonzero(new), len(terms))
        ends = np.append(starts, len(terms))  # the last row has no postings
        named = pa.array(np.append(signed(terms[starts[:-1]]), 0), mask=np.append(np.zeros(len(starts) - 1, bool), True))
        own = np.zeros(len(ends), np.int32)
        own[-1] = self.rows
        length_ends = ends.copy()
        length_ends[-1] += self.rows
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(starts), block, np.int64)), named, _list(place[docs], ends, pa.int32()), _list(counts, ends, pa.int32()),
            _list(np.concatenate([lengths[docs], lengths[order]]), length_ends, pa.int32()),
            pa.ListArray.from_arrays(pa.array(own), ids.take(pa.array(order)))],
            names=["block", "term", "docs", "counts", "lengths", "ids"])


def inverted(docs: DataFrame, passed: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """The lists of each block: rows of `LISTS`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in slices(batches):
            block.add(batch.column("id"), Texts(batch.column("text"), space=BETWEEN), passed)
            if block.rows >= BLOCK_DOCS or block.size >= BLOCK_POSTINGS:
                yield block.lists(number)
                number, block = number + 1, _Block()
        if block.rows:
            yield block.lists(number)

    named = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return named.mapInArrow(run, LISTS)


def owned(terms: DataFrame, lists: DataFrame, n: int) -> DataFrame:
    """`(items, term, weight, owner, members, rest)`: an owner's terms with the items that hold them.

    `rest` has, for each member, the most that the owners after this one can add to its scores.
    """
    df = lists.where("term is not null").groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    weight = F.floor(F.log((F.lit(2.0) * n + 2) / (F.lit(2.0) * F.col("df") + 1)) * 1000).cast("long")
    owner = sum((F.when(F.col("df") > share * n, 1).otherwise(0) for share in OWNERS), F.lit(0))
    weighed = terms.join(df, "term").select("items", "item", "term", weight.alias("weight"), owner.alias("owner"))
    later = weighed.groupBy("items", "item").agg(*[
        (F.sum(F.when(F.col("owner") > i, F.col("weight")).otherwise(0)) * MOST_SHARE).alias(f"after{i}") for i in range(len(OWNERS) + 1)])
    rest = F.element_at(F.array(*[f"after{i}" for i in range(len(OWNERS) + 1)]), F.col("owner") + 1)
    return (
        weighed.join(later, ["items", "item"]).groupBy("items", "term", "weight", "owner")
        .agg(F.collect_list(F.struct("item", rest.alias("rest"))).alias("held"))
        .select("items", "term", "weight", "owner", F.col("held.item").alias("members"), F.col("held.rest").alias("rest")))


def _stage(n: int, total: int, k: int, last: bool):
    """What one owner does with the bundles of a block and a group of items."""

    def run(key, bundles: pa.Table, lists: pa.Table) -> pa.Table:
        block, items = (x.as_py() for x in key)
        sums: dict[int, np.ndarray] = {}
        rest: dict[int, int] = {}
        tops = [pc.max(pc.list_flatten(t.column("docs"))).as_py() for t in (bundles, lists) if t.num_rows]
        size = max((t for t in tops if t is not None), default=-1) + 1

        def values(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
            flat = column.combine_chunks()
            return flat.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(pc.list_value_length(flat).to_numpy()))

        if bundles.num_rows:
            docs, at = values(bundles.column("docs"))
            scores, _ = values(bundles.column("scores"))
            for i, item in enumerate(bundles.column("item").to_pylist()):
                sums[item] = np.zeros(size, np.int64)
                sums[item][docs[at[i]:at[i + 1]]] = scores[at[i]:at[i + 1]]
        if lists.num_rows:
            docs, at = values(lists.column("docs"))
            count = values(lists.column("counts"))[0].astype(np.int64)
            length = values(lists.column("lengths"))[0].astype(np.int64)
            share = (1_000_000_000 * count) // (1000 * count + 8 * (10 + (90 * length * n) // total))
            members, of = values(lists.column("members"))
            after, _ = values(lists.column("rest"))
            for i, weight in enumerate(lists.column("weight").to_pylist()):
                added = share[at[i]:at[i + 1]] * weight
                for j in range(of[i], of[i + 1]):
                    item = int(members[j])
                    if item not in sums:
                        sums[item] = np.zeros(size, np.int64)
                    sums[item][docs[at[i]:at[i + 1]]] += added
                    rest[item] = int(after[j])
        found = []
        for item, score in sorted(sums.items()):
            places = np.flatnonzero(score)
            score = score[places]
            if last:
                best = np.lexsort((places, -score))[:k]
                places, score = places[best], score[best]
            elif item in rest and len(score) > k:
                open_ = score + rest[item] >= np.partition(score, len(score) - k)[len(score) - k]
                places, score = places[open_], score[open_]
            if len(places):
                found.append((item, places, score))
        starts = np.append(0, np.cumsum([len(x[1]) for x in found], dtype=np.int64))
        none = np.zeros(0, np.int64)
        return pa.table({
            "block": pa.array([block] * len(found), pa.int64()), "items": pa.array([items] * len(found), pa.int64()),
            "item": pa.array([x[0] for x in found], pa.int32()),
            "docs": _list(np.concatenate([none, *[x[1] for x in found]]), starts, pa.int32()),
            "scores": _list(np.concatenate([none, *[x[2] for x in found]]), starts, pa.int64())})

    return run


def search(
    docs: DataFrame, items: DataFrame, work: Work, k: int = 10, *, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """`(items, item, item_id, rank, doc_id, score)`: the k best documents of each row of `items`; the first two name the row."""
    spark = docs.sparkSession
    terms = work.keep(item_terms(items, item_col, item_text), "terms")
    lists = work.keep(inverted(docs, sieve(terms, "term", FILTER_BITS), id_col, text_col), "lists")
    blocks = lists.where("term is null")
    size = blocks.select(F.explode("lengths").alias("length")).where("length > 0").agg(
        F.count("*").alias("n"), F.sum("length").alias("total")).first()
    n, total = size["n"], size["total"] or 1
    owners = work.keep(owned(terms, lists, n), "owners")
    # A common term has a list in every block: an ordinary join, which Spark sends if the owners are small and splits if one key is hot.
    path = work.path("owned")
    lists.where("term is not null").drop("ids").join(owners, "term").write.partitionBy("owner").parquet(path)
    key, bundles = ["block", "items"], spark.createDataFrame([], BUNDLE)
    kinds = "block long, term long, docs array<int>, counts array<int>, lengths array<int>, items long, weight long, members array<int>, rest array<long>, owner int"
    for i in range(len(OWNERS) + 1):
        own = spark.read.schema(kinds).parquet(path).where(F.col("owner") == i).drop("owner", "term")
        stage = _stage(n, total, k, last=i == len(OWNERS))
        bundles = work.keep(bundles.groupBy(*key).cogroup(own.groupBy(*key)).applyInArrow(stage, BUNDLE), f"bundles{i}")
    best = bundles.select("block", "items", "item", F.explode(F.arrays_zip("docs", "scores")).alias("at"))
    named = best.join(blocks.select("block", "ids"), "block").select(
        "items", "item", F.element_at("ids", F.col("at.docs") + 1).alias("doc_id"), F.col("at.scores").alias("score"))
    rank = F.row_number().over(Window.partitionBy("items", "item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    top = named.withColumn("rank", rank).where(F.col("rank") <= k)
    names = terms.groupBy("items", "item").agg(F.first("item_id").alias("item_id"))
    return top.join(names, ["items", "item"]).select("items", "item", "item_id", "rank", "doc_id", "score")


SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
sums AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), sums),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (doc_id), sums GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""


@query("op11_lexical_search", SQL)
def op11(spark, sf_dir):
    with Work(spark, "op11") as work:
        found = search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), work)
        return result(found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
