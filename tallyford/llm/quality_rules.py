"""Quality rules: counts per text and a log-likelihood ratio between trusted texts and the whole corpus.

Word unigrams and bigrams are hashed to BUCKETS buckets. Two multinomials over them are counted: one from the trusted
documents, one from all documents, copies included. A document's score is the sum of
`log(p_trusted / p_raw)` over its n-grams, divided by their number. The same threshold holds for every document: it is the
KEEP_SHARE quantile, taken from the low end, of the scores of trusted documents that were held out of the trusted
counts. All documents are counted and scored; bucket counts, not texts, are gathered.

A null text has no words. A document without n-grams has score 0. A trusted id that repeats counts for each of its rows; trusted
ids without a document, and null ids, count for nothing. Without trusted documents all scores are 0 and only the base
rules decide. Equal rows are separate; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .registry import query, table
from .textscan import Texts, mix, slices, windows
from .work import Work, result

BUCKETS = 1 << 16
# Held-out trusted documents that may fall under the threshold.
KEEP_SHARE = 0.002
MIN_WORDS = 20
# Of a hundred words.
MOST_REPEATED = 30
REPEAT_WINDOW = 8

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _per_text(texts: Texts, values: np.ndarray) -> np.ndarray:
    """Sums of a value per byte over each text."""
    sums = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return sums[texts.offset[1:]] - sums[texts.offset[:-1]]


def repeated_words(words: np.ndarray, width: int) -> int:
    """Words that lie in a window of `width` words which occurs twice or more in the text."""
    found = windows(words, width)
    if len(found) < 2:
        return 0
    order = np.argsort(found, kind="stable")
    same = found[order][1:] == found[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(found), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def repeated_lines(texts: Texts) -> np.ndarray:
    """Per text the lines with a word that equal an earlier line."""
    n = len(texts.raw)
    begins = np.unique(np.concatenate((texts.offset[:-1][texts.offset[:-1] < n], np.flatnonzero(texts.raw == 10) + 1)))
    begins = begins[begins < n]
    if not len(begins):
        return np.zeros(texts.n, np.int64)
    ends = np.append(begins[1:], n)
    of = np.searchsorted(texts.offset, begins, "right") - 1
    # A line ends before its line end, except the last of a text.
    ends = ends - ((ends > begins) & (texts.raw[ends - 1] == 10))
    has_word = np.searchsorted(texts.start, ends) > np.searchsorted(texts.start, begins)
    begins, ends, of = begins[has_word], ends[has_word], of[has_word]
    name = texts.ranges(begins, ends)
    order = np.lexsort((name, of))
    name, of = name[order], of[order]
    again = np.concatenate(([False], (name[1:] == name[:-1]) & (of[1:] == of[:-1]))) if len(name) else np.zeros(0, bool)
    return np.bincount(of[again], minlength=texts.n).astype(np.int64)


def base_counts(texts: Texts, words: np.ndarray) -> list[np.ndarray]:
    """Words, their characters, symbols, repeated lines and words in repeated windows of each text."""
    letters = texts.in_word & ((texts.raw & 0xC0) != 0x80)
    bounds = texts.first.tolist()
    repeated = [repeated_words(words[a:b], REPEAT_WINDOW) if b - a > REPEAT_WINDOW else 0 for a, b in zip(bounds[:-1], bounds[1:])]
    return [np.diff(texts.first), _per_text(texts, letters), _per_text(texts, _SYMBOL[texts.raw]), repeated_lines(texts),
            np.array(repeated, np.int64)]


def grams(texts: Texts, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every unigram and bigram, and the text it belongs to."""
    of = texts.text_of_word()
    pairs = windows(words, 2)
    inside = of[1:] == of[:-1]
    one = (mix(words) & np.uint64(BUCKETS - 1)).astype(np.int64)
    two = (pairs[inside] & np.uint64(BUCKETS - 1)).astype(np.int64)
    return np.concatenate((one, two)), np.concatenate((of, of[1:][inside]))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket counts of a task: of all its documents, and of the trusted ones that are not held out."""
    raw, trusted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in slices(batches):
        texts = Texts(batch.column("text"))
        bucket, of = grams(texts, texts.words())
        raw += np.bincount(bucket, minlength=BUCKETS)
        times = batch.column("times").to_numpy()[of]
        trusted += np.bincount(bucket, weights=times, minlength=BUCKETS).astype(np.int64)
    some = np.flatnonzero(raw)
    yield pa.record_batch([pa.array(some), pa.array(raw[some]), pa.array(trusted[some])], ["bucket", "raw", "trusted"])


def ratios(raw: np.ndarray, trusted: np.ndarray) -> np.ndarray:
    """`log(p_trusted / p_raw)` per bucket, with half a count added everywhere."""
    p, q = trusted + 0.5, raw + 0.5
    return np.log(p / p.sum()) - np.log(q / q.sum()) if trusted.sum() else np.zeros(len(raw))


def _score(ratio, with_base: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = ratio.value
        for batch in slices(batches):
            texts = Texts(batch.column("text"), lower=False)
            columns = base_counts(texts, texts.words()) if with_base else []
            folded = Texts(batch.column("text"))
            bucket, of = grams(folded, folded.words())
            n = np.bincount(of, minlength=texts.n)
            total = np.bincount(of, weights=value[bucket], minlength=texts.n)
            score = np.round(total / np.maximum(n, 1), 9)
            yield pa.record_batch([batch.column("id"), pa.array(score), *map(pa.array, columns)],
                                  ["id", "score", *[x.split()[0] for x in _BASE.split(", ")][:len(columns)]])

    return run


def held_out(key: Column) -> Column:
    """A fifth of the trusted documents sets the threshold and is not counted."""
    return F.pmod(F.crc32(key.cast("string")), F.lit(5)) == 0


def ruled(
    docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep_share: float = KEEP_SHARE,
) -> DataFrame:
    """Per document the base counts, `base_failed`, `score` (log ratio per n-gram), `threshold` and `kept`.

    `trusted` has the ids of trusted documents in its column `id_col`.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_sql = dict(rows.dtypes)["id"]
    good = trusted.select(F.col(id_col).alias("id")).where("id is not null").distinct()
    with Work(spark, "quality-rules") as work:
        # Trusted ids grow with the corpus, so texts meet them by a merge join at every size.
        marked = rows.join(good.withColumn("good", F.lit(True)).hint("merge"), "id", "left").select(
            "text", F.when(F.col("good") & ~held_out(F.col("id")), 1).otherwise(0).cast("long").alias("times"))
        counts = marked.mapInArrow(_count, "bucket long, raw long, trusted long")
        sums = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")).toPandas()
        both = np.zeros((2, BUCKETS), np.int64)
        both[0, sums["bucket"]], both[1, sums["bucket"]] = sums["raw"], sums["trusted"]
        ratio = spark.sparkContext.broadcast(ratios(both[0], both[1]))
        scored = work.keep(rows.mapInArrow(_score(ratio, True), f"id {id_sql}, score double, {_BASE}"), "scored")
        # Scores are cut to steps, so the quantile is exact on counts of steps.
        control = scored.join(good, "id").where(held_out(F.col("id"))).groupBy(F.floor(F.col("score") * 10_000).alias("step")).count().toPandas().sort_values("step")
        if both[1].sum() and len(control):
            below = control["count"].cumsum()
            threshold = float(control["step"][below > keep_share * control["count"].sum()].iloc[0]) / 10_000
        else:
            threshold = float("-inf")
        failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > MOST_REPEATED * F.col("n_words"))
        out = result(scored.withColumn("base_failed", failed).withColumn("threshold", F.lit(threshold))
                     .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.col("threshold"))).withColumnRenamed("id", id_col))
        ratio.destroy()
        return out


@query("op5_quality_rules")
def op5(spark, sf_dir):
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return ruled(table(spark, sf_dir, "documents"), trusted).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
