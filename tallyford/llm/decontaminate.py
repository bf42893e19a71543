"""Benchmark decontamination by spaced seeds.

Texts are lower-cased runs of letters and digits. Fixed masks look at some places of a span of words and ignore
the others, so a substituted word at an ignored place does not hide a passage. Seeds of the test items become a
Bloom filter of fixed size; documents send only the seeds that pass it, each with the words around it, to the
join with the test seeds. Around every hit the document and the item are laid over each other without gaps: the
document is contaminated where `window` words in a row (the whole item, if that is shorter) have at least `similar`
of their places equal. The same passage hit by several seeds is one row.

In 13 words in a row, any two may be substituted: some placement of a mask avoids both (a test tries all pairs).
Shorter items have lighter masks of their own, so that every substitution which the check allows them (one in 6 to 9
words, two in 10 to 12) is found as well; documents are searched by those only where there are such items.
Hits are found in all documents; the Bloom filter only saves shuffle, a full
filter lets more seeds through and the result stays the same. Seeds are dealt by hash and place, so a common
passage's hits spread over tasks; a document's hits with one item are reduced before they meet.

Whole texts are searched, however long: words go through in slices, and a hit carries the words around it only.
Nulls and empty texts, on either side, are never contaminated; without documents or items there are no rows. Items with fewer than MIN_WORDS words are not
searched for, as they say too little. Equal rows are separate; ids may repeat. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textscan
from .registry import query, table
from .textscan import Texts, mix, signed, slices
from .work import Work, result

# Places that count. The last two hit 13 words with any two substitutions, the first also short items.
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
# For items under 13 words. The first five leave out one word of any six, the last two neighbours in the middle of ten.
LIGHT_MASKS = ((0, 1, 2, 3, 4), (0, 2, 3, 4, 5), (0, 1, 3, 4, 5), (0, 1, 2, 4, 5), (0, 1, 2, 3, 5), (0, 1, 2, 3, 6))
WINDOW = 13
SIMILAR = 0.8
MIN_WORDS = 6
BLOOM_BITS = 26
SHIFTS = (0, 19, 38)
# Words of the document that go along with a hit, before and after its first word.
AROUND = 32


def normal(text):
    """Lower-case text in which everything but letters, digits and marks is a space."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\p{M}]+", " ")


def _seeds(words: np.ndarray, first: np.ndarray, mask: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every placement of a mask that stays within its text."""
    span = mask[-1] + 1
    n = len(words) - span + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.full(n, sum(1 << place for place in mask), np.uint64)
    for i, place in enumerate(mask):
        total += words[place:place + n] * np.uint64(pow(textscan._PRIME, 5 * i + 3, 1 << 64))
    inside = np.ones(n, bool)
    for b in first[1:-1].tolist():
        inside[max(0, b - span + 1):b] = False
    at = np.flatnonzero(inside)
    return mix(total[at]), at


def _bit(hashes: np.ndarray, shift: int) -> np.ndarray:
    return ((hashes >> np.uint64(shift)) & np.uint64((1 << BLOOM_BITS) - 1)).astype(np.int64)


def _short(words: np.ndarray) -> np.ndarray:
    """Word hashes as they are compared: 32 bits."""
    return (words >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = Texts(batch.column("text"))
        words = texts.words()
        rows = []
        for i in range(texts.n):
            own = words[texts.first[i]:texts.first[i + 1]]
            if len(own) >= MIN_WORDS:
                for mask in MASKS + (LIGHT_MASKS if len(own) < WINDOW else ()):
                    seeds, at = _seeds(own, np.array([0, len(own)]), mask)
                    rows.append((np.full(len(at), i), seeds, at))
        if rows:
            which, seeds, at = (np.concatenate(x) for x in zip(*rows))
            short = [_short(words[texts.first[i]:texts.first[i + 1]]) for i in range(texts.n)]
            a, b = np.maximum(0, at - AROUND), at + AROUND
            yield pa.record_batch([
                pa.array(signed(seeds)), batch.column("item").take(pa.array(which)),
                pa.array(at - a, pa.int32()), pa.array([short[i][x:y] for i, x, y in zip(which, a, b)], pa.list_(pa.int32())),
                pa.array([len(short[i]) for i in which], pa.int32())],
                ["seed", "item", "item_before", "item_words", "item_length"])


def _hits(bloom, masks: tuple[tuple[int, ...], ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bloom.value
        for batch in slices(batches):
            texts = Texts(batch.column("text"))
            words = texts.words()
            seeds, places = [], []
            for mask in masks:
                found, at = _seeds(words, texts.first, mask)
                for shift in SHIFTS:
                    keep = bits[_bit(found, shift)]
                    found, at = found[keep], at[keep]
                seeds.append(found)
                places.append(at)
            seed, at = np.concatenate(seeds), np.concatenate(places)
            if not len(at):
                continue
            which = np.searchsorted(texts.first, at, "right") - 1
            begin, end = texts.first[which], texts.first[which + 1]
            a, b = np.maximum(begin, at - AROUND), np.minimum(end, at + AROUND)
            short = _short(words)
            yield pa.record_batch([
                pa.array(signed(seed)), batch.column("doc").take(pa.array(which)), pa.array(at - begin, pa.int64()),
                pa.array(at - a, pa.int32()), pa.array([short[x:y] for x, y in zip(a, b)], pa.list_(pa.int32()))],
                ["seed", "doc", "at", "before", "words"])

    return run


def _verified(window: int, similar: float):
    """Hits whose surroundings agree: the best window over each hit and its place in the document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_words, item_words = batch.column("words"), batch.column("item_words")
            before, item_before = (batch.column(c).to_numpy() for c in ("before", "item_before"))
            length = batch.column("item_length").to_numpy()
            keep, equal, wide, start = (np.zeros(batch.num_rows, t) for t in (bool, np.int32, np.int32, np.int64))
            for i in range(batch.num_rows):
                x, y = doc_words[i].values.to_numpy(), item_words[i].values.to_numpy()
                left = min(before[i], item_before[i])
                right = min(len(x) - before[i], len(y) - item_before[i])
                same = x[before[i] - left:before[i] + right] == y[item_before[i] - left:item_before[i] + right]
                size = min(window, length[i])
                if len(same) < size:
                    continue
                sums = np.concatenate(([0], np.cumsum(same)))
                count = sums[size:] - sums[:-size]
                best = int(count.argmax())
                if count[best] >= similar * size:
                    keep[i], equal[i], wide[i], start[i] = True, count[best], size, best - left
            place = batch.column("at").to_numpy() + start
            rows = pa.record_batch(
                [batch.column("doc"), batch.column("item"), pa.array(place), pa.array(equal), pa.array(wide)],
                ["doc", "item", "place", "equal", "wide"])
            yield rows.filter(pa.array(keep))

    return run


def contaminated(
    docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, similar: float = SIMILAR,
) -> DataFrame:
    """`(id_col, item_col, windows, equal_words, window_words, first_word)` for each document and item that overlap.

    `windows` counts the verified places, `equal_words` of `window_words` agree in the best one, `first_word` is the number
    of the document's word where the first one begins.
    """
    spark = docs.sparkSession
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc"), normal(F.col(text_col)).alias("text"))
    tests = items.where(F.col(item_text_col).isNotNull()).select(F.col(item_col).alias("item"), normal(F.col(item_text_col)).alias("text"))
    doc_type, item_type = dict(texts.dtypes)["doc"], dict(tests.dtypes)["item"]
    with Work(spark, "decontaminate") as work:
        seeds = work.keep(tests.mapInArrow(
            _item_seeds, f"seed long, item {item_type}, item_before int, item_words array<int>, item_length int"), "seeds")

        def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hashes = batch.column("seed").to_numpy().view(np.uint64)
                found = np.unique(np.concatenate([_bit(hashes, s) for s in SHIFTS]))
                yield pa.record_batch([pa.array(found >> 6), pa.array(np.left_shift(np.uint64(1), (found & 63).astype(np.uint64)).view(np.int64))], ["slot", "bits"])

        slots = seeds.select("seed").mapInArrow(bits, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toPandas()
        # 2 ** BLOOM_BITS bits, whatever the number of items.
        filled = np.zeros(1 << (BLOOM_BITS - 6), np.uint64)
        filled[slots["slot"].to_numpy(np.int64)] = slots["bits"].to_numpy(np.int64).view(np.uint64)
        bloom = spark.sparkContext.broadcast(np.unpackbits(filled.view(np.uint8), bitorder="little").view(bool))
        short = not seeds.where(F.col("item_length") < WINDOW).isEmpty()
        masks = MASKS + (LIGHT_MASKS if short else ())
        hits = work.keep(texts.mapInArrow(_hits(bloom, masks), f"seed long, doc {doc_type}, at long, before int, words array<int>"), "hits")
        found = hits.join(seeds, "seed").mapInArrow(_verified(window, similar), f"doc {doc_type}, item {item_type}, place long, equal int, wide int")
        best = F.max(F.struct("equal", "wide"))
        out = result(found.groupBy("doc", "item").agg(
            F.count_distinct("place").alias("windows"), best["equal"].alias("equal_words"), best["wide"].alias("window_words"), F.min("place").alias("first_word")
        ).select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "windows", "equal_words", "window_words", "first_word"))
        bloom.destroy()
        return out


@query("op4_decontaminate")
def op4(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
