"""Near duplicates: an exact Jaccard join of word shingles by parity sketches.

A document is the set of its distinct k-word shingles (lower-cased A-Z; fewer words make one shingle). Two
documents link when `intersection / union >= threshold`; both numbers are whole, so the test is exact.

1. Documents with equal sets form a class; all later work is on classes.
2. Sizes fall into bands, powers of two. In a band the shingle hashes are dealt to m parts by their leading
   bits, and the shingles of a part are XORed to one word. A shingle in one set only changes one word, so the
   number of differing words is a lower bound of the symmetric difference, which for linked sets is at most
   `d = (|A| + |B|)(1 - t)/(1 + t)`. At least m - d words agree, so among the first d + 1 words of each set,
   taken in one order for all, some word is the same in both (pigeonhole). Those d + 1 words are the join keys.
   Words that hold a shingle which few documents have come first; a list of frequent shingles, whose length
   has a proven bound, gives that order and cannot change the result.
3. Within each key, documents are compared with two centres: the one that shares most keys and a random one.
   Pairs whose parity sketches, of two to four bits per shingle, differ in more than d bits are dropped, the
   others verified on the full sets. Keys whose documents then are in one component need nothing more. In the others all pairs of
   documents of different components and like size are tested inside a task, block against block, by their sketches folded
   to 512 bits, then to ever more, at last by the whole sketches. Only pairs that pass leave the task and go the same way. A sketch's
   width follows the set's size, so unrelated texts of any length fail. No link between components is missed.

Nulls and texts without words have an empty set, link with nothing and are components of their own. Equal
rows and repeated ids, null ones too, stay rows of their own: a class's text is found by its id and its text's hash.
Texts count whole, whatever their length; only the id and text columns are read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graph
from .registry import query, table
from .sieve import passes, sieve
from .textscan import Texts, mix, shingles, signed, slices
from .work import Work, result

# A shingle that this share of the documents has is frequent. At most (mean set size) * 2 / share shingles are.
FREQUENT_SHARE = 1 / 1024
# Documents of which a task counts shingles together.
COUNTED_TOGETHER = 8192
SKETCH_BYTES = 64
# Folds of a sketch that pairs of a block are tested by before the whole one: each has so many times the bytes of the one before.
FOLDED = 8
# Bytes of sketches that are compared at once.
COMPARED = 1 << 22
# Pairs of a block that are held at once, and more only for one row on the left.
PAIRS = 1 << 16
# The filter that keeps texts of no pair from the join has 2 ** 23 bits.
NEEDED_BITS = 23
# Documents of one key that a task tests against as many others.
BLOCK = 4096


def class_id(hashes: np.ndarray) -> int:
    """A 64-bit name of a set of shingles."""
    return int(signed(mix(mix(hashes ^ np.uint64(0x5DEECE66D)).sum(keepdims=True) + np.uint64(len(hashes))))[0])


def parity(hashes: np.ndarray) -> bytes:
    """Each shingle flips one bit; there are two to four bits for each shingle, 512 at least."""
    size = max(8 * SKETCH_BYTES, 2 << (len(hashes) - 1).bit_length())
    bits = np.bincount((hashes & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """The parity sketch of the same set with fewer bytes; sizes are powers of two."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, size), axis=0)


def apart(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ: at most the size of the sets' symmetric difference."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    return int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum())


def differing(a: int, b: int, num: int, den: int) -> int:
    """The largest symmetric difference of linked sets of these sizes."""
    return (a + b) * (den - num) // (den + num)


def layouts(n: int, num: int, den: int) -> Iterator[tuple[int, int, int]]:
    """(band, parts, keys) for each band in which a set of n shingles can meet a partner of at least its size."""
    band, partner = n.bit_length() - 1, n * den // num
    for k in (band, band + 1):
        top = (2 << k) - 1
        if partner >= 1 << k:
            most = differing(top, top, num, den)
            yield k, max(2 * (most + 1), most + 16), differing(n, min(partner, top), num, den) + 1


def keys(hashes: np.ndarray, frequent: np.ndarray, num: int, den: int) -> list[np.ndarray]:
    """The join keys of a sorted set; `frequent` tells which of its shingles are."""
    out = []
    code = mix(hashes + np.uint64(0x632BE59BD9B4E019))
    for band, parts, wanted in layouts(len(hashes), num, den):
        part = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        begin = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1))
        word = np.bitwise_xor.reduceat(code, begin)
        where = part[begin]
        rare = np.logical_or.reduceat(~frequent, begin)
        salt = np.uint64(band * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF)
        name = mix(word + mix(where + salt))
        if len(name) > wanted:
            order = (name >> np.uint64(1)) | np.where(rare, np.uint64(0), np.uint64(1 << 63))
            name = name[np.argpartition(order, wanted - 1)[:wanted]]
        elif len(name) < wanted:
            empty = mix(mix(np.setdiff1d(np.arange(parts, dtype=np.uint64), where) + salt))
            empty.sort()
            name = np.concatenate((name, empty[:wanted - len(name)]))
        out.append(name)
    return out


def _summaries(id_type: pa.DataType, k: int):
    """Per document its class, size and sketch; per some thousand documents the shingles that are frequent in them."""
    schema = pa.schema([("id", id_type), ("text_hash", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("sketch", pa.binary()),
                        ("shingle", pa.int64()), ("docs", pa.int64())])

    def run(batches):
        sets: list[np.ndarray] = []

        def frequent():
            found = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            value, count = np.unique(found, return_counts=True)
            keep = count >= max(2, len(sets) * FREQUENT_SHARE)
            rows = int(keep.sum())
            nulls = {name: pa.nulls(rows, schema.field(name).type) for name in schema.names}
            return pa.record_batch([
                *[nulls[x] for x in schema.names[:-2]], pa.array(signed(value[keep])), pa.array(count[keep].astype(np.int64))
            ], schema=schema)

        for batch in slices(batches):
            found = shingles(Texts(batch.column("text")), k)
            full = [x for x in found if len(x)]
            full_sketch = [parity(x) if len(x) else None for x in found]
            name = np.array([class_id(x) if len(x) else 0 for x in found], np.int64)
            size = np.array([len(x) for x in found], np.int64)
            yield pa.record_batch([
                batch.column("id"), batch.column("text_hash"), pa.array(size), pa.array(name, mask=size == 0), pa.array(full_sketch, pa.binary()),
                pa.nulls(len(found), pa.int64()), pa.nulls(len(found), pa.int64())], schema=schema)
            sets += full
            if len(sets) >= COUNTED_TOGETHER:
                yield frequent()
                sets = []
        yield frequent()

    return run


def _keys(k: int, num: int, den: int, frequent):
    def run(batches):
        seen: set[int] = set()
        known = frequent.value
        maybe = np.zeros(1 << 20, bool)
        maybe[(known >> np.uint64(44)).astype(np.int64)] = True
        for batch in slices(batches):
            names, owners = [], []
            for x in shingles(Texts(batch.column("text")), k):
                if not len(x):
                    continue
                owner = class_id(x)
                if owner in seen:
                    continue
                seen.add(owner)
                is_known = maybe[(x >> np.uint64(44)).astype(np.int64)]
                if len(known) and is_known.any():
                    at = x[is_known]
                    is_known[is_known] = known[np.minimum(np.searchsorted(known, at), len(known) - 1)] == at
                for found in keys(x, is_known, num, den):
                    names.append(found)
                    owners.append(np.full(len(found), owner, np.int64))
            if names:
                yield pa.record_batch([pa.array(signed(np.concatenate(names))), pa.array(np.concatenate(owners))], ["key", "cls"])

    return run


def _sets(k: int, sent):
    """The sets of the texts that may be needed."""
    def run(batches):
        for batch in batches:
            needed = batch.filter(pa.array(passes(sent.value, batch.column("text_hash").to_numpy().view(np.uint64))))
            for some in slices(iter([needed])):
                found = shingles(Texts(some.column("text")), k)
                yield pa.record_batch([some.column("id"), some.column("text_hash"), pa.array([x.tobytes() for x in found], pa.binary())],
                                      ["id", "text_hash", "set"])

    return run


def _verified(num: int, den: int):
    def run(batches):
        for batch in batches:
            a, b = batch.column("a_set"), batch.column("b_set")
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = np.frombuffer(a[i].as_buffer(), np.uint64), np.frombuffer(b[i].as_buffer(), np.uint64)
                at = np.searchsorted(x, y)
                at[at == len(x)] = 0
                both = int((x[at] == y).sum())
                keep[i] = den * both >= num * (len(x) + len(y) - both)
            yield pa.record_batch([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    return run


def _block_pairs(num: int, den: int):
    """Pairs of different components in each (key, block, block) whose sketches allow a link; rows come sorted by group."""
    names = ["key", "low", "high", "block", "cls", "label", "n", "sketch"]

    def tested(g: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        one, other = g["block"] == g["low"][0], g["block"] == g["high"][0]
        left, right = np.flatnonzero(one), np.flatnonzero(other)
        right = right[np.argsort(g["n"][right], kind="stable")]
        sizes = g["n"][right]
        width = np.array([len(x) for x in g["sketch"]])
        folds: dict[int, np.ndarray] = {}

        def at_width(size: int, rows: np.ndarray) -> np.ndarray:
            """The sketches of some rows, folded to one size that none is below."""
            if size == SKETCH_BYTES:
                if size not in folds:
                    folds[size] = np.stack([folded(np.frombuffer(x, np.uint8), size) for x in g["sketch"]]).view(np.uint64)
                return folds[size][rows]
            value, which = np.unique(rows, return_inverse=True)
            return np.stack([folded(np.frombuffer(g["sketch"][i], np.uint8), size) for i in value]).view(np.uint64)[which]

        # Of each row on the left, the rows on the right of a size that could link.
        n = g["n"][left]
        firsts = np.searchsorted(sizes, -(-n * num // den))
        counts = np.maximum(np.searchsorted(sizes, n * den // num, "right") - firsts, 0)
        ends = np.cumsum(counts)
        out_a, out_b, begin = [], [], 0
        while begin < len(left):
            done = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
            part, first, most, begin = left[begin:end], firsts[begin:end], counts[begin:end], end
            x = np.repeat(part, most)
            y = right[np.arange(len(x)) - np.repeat(np.cumsum(most) - most, most) + np.repeat(first, most)]
            keep = g["label"][x] != g["label"][y]
            if g["low"][0] == g["high"][0]:
                keep &= g["cls"][x] < g["cls"][y]
            x, y = x[keep], y[keep]
            allowed = (g["n"][x] + g["n"][y]) * (den - num) // (den + num)
            whole = np.minimum(width[x], width[y])
            size, alive, passed = SKETCH_BYTES, np.arange(len(x)), []
            while len(alive):
                near = np.zeros(len(alive), bool)
                step = max(COMPARED // size, 1)
                for i in range(0, len(alive), step):
                    some = alive[i:i + step]
                    differ = np.bitwise_count(at_width(size, x[some]) ^ at_width(size, y[some])).sum(1, dtype=np.int64)
                    near[i:i + step] = differ <= allowed[some]
                alive = alive[near]
                passed.append(alive[whole[alive] == size])
                alive = alive[whole[alive] > size]
                size = min(size * FOLDED, int(whole[alive].min(initial=size * FOLDED)))
            keep = np.concatenate(passed) if passed else np.zeros(0, np.int64)
            out_a.append(g["cls"][x[keep]])
            out_b.append(g["cls"][y[keep]])
        return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (np.zeros(0, np.int64),) * 2

    def run(batches):
        held: dict[str, np.ndarray] | None = None

        def groups(columns, last):
            change = np.zeros(len(columns["key"]), bool)
            for name in ("key", "low", "high"):
                change[1:] |= columns[name][1:] != columns[name][:-1]
            edges = [0, *np.flatnonzero(change).tolist(), len(change)]
            stop = len(edges) - 1 if last else len(edges) - 2
            found = [tested({n: c[edges[i]:edges[i + 1]] for n, c in columns.items()}) for i in range(stop)]
            rest = {n: c[edges[stop]:] for n, c in columns.items()}
            a = np.concatenate([np.zeros(0, np.int64), *[x[0] for x in found]])
            b = np.concatenate([np.zeros(0, np.int64), *[x[1] for x in found]])
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
            return rest, pa.record_batch([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

        for batch in batches:
            columns = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
            if held is not None:
                columns = {n: np.concatenate((held[n], columns[n])) for n in names}
            if len(columns["key"]):
                held, out = groups(columns, False)
                yield out
        if held is not None and len(held["key"]):
            yield groups(held, True)[1]

    return run


def _possible(num: int, den: int):
    def run(batches):
        for batch in batches:
            a, b = batch.column("a_sketch").to_pylist(), batch.column("b_sketch").to_pylist()
            most = ((batch.column("a_n").to_numpy() + batch.column("b_n").to_numpy()) * (den - num) // (den + num)).tolist()
            keep = pa.array([apart(x, y) <= d for x, y, d in zip(a, b, most)], pa.bool_())
            yield pa.record_batch([batch.column("a"), batch.column("b")], ["a", "b"]).filter(keep)

    return run


def _plausible(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose sizes and sketches allow a link."""
    def side(x: str) -> DataFrame:
        return classes.select(F.col("cls").alias(x), F.col("n").alias(f"{x}_n"), F.col("sketch").alias(f"{x}_sketch"))

    return pairs.join(side("a"), "a").join(side("b"), "b").where(
        F.least("a_n", "b_n") * den >= F.greatest("a_n", "b_n") * num).mapInArrow(_possible(num, den), "a long, b long")


def _links(pairs: DataFrame, classes: DataFrame, texts: DataFrame, work: Work, k: int, num: int, den: int) -> DataFrame:
    """The pairs that link, by their full sets."""
    pairs = work.keep(pairs, "pairs")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    needed = work.keep(needed.join(classes, "cls").select("cls", F.col("one.id").alias("one_id"), F.col("one.text_hash").alias("one_text")), "needed")
    # Texts are long and few are needed: most stay where they are. Their sets are made before the join, in the pass of the filter: with
    # a second Python step behind a broadcast join an executor holds four workers, not two.
    spark = texts.sparkSession
    sent = spark.sparkContext.broadcast(sieve(needed, "one_text", NEEDED_BITS))
    made = texts.mapInArrow(_sets(k, sent), f"id {dict(texts.dtypes)['id']}, text_hash long, set binary")
    sets = (
        made.join(needed, (made.text_hash == needed.one_text) & made.id.eqNullSafe(needed.one_id))
        .groupBy("cls").agg(F.first("set").alias("set")))
    sets = work.keep(sets, "sets")
    sent.destroy()
    work.drop(needed)
    both = (
        pairs.join(sets.select(F.col("cls").alias("a"), F.col("set").alias("a_set")), "a")
        .join(sets.select(F.col("cls").alias("b"), F.col("set").alias("b_set")), "b"))
    links = work.keep(both.mapInArrow(_verified(num, den), "a long, b long"), "links")
    work.drop(sets)
    work.drop(pairs)
    return links


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100,
) -> DataFrame:
    """Per document `(id_col, n_shingles, component_id, class_size, text_hash, component)`; links need `den * intersection >= num * union`.

    `component_id` is the smallest id that links reach, `class_size` the number of documents with the same set. `component` names
    the documents that links join, also where ids repeat or are null; it is null without words. `text_hash` tells rows of one id apart.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = pa.int64() if dict(texts.dtypes)["id"] == "bigint" else pa.string()
    if id_type == pa.string():
        texts = texts.withColumn("id", F.col("id").cast("string"))
    id_sql = dict(texts.dtypes)["id"]
    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    with Work(spark, "ngram-join") as work:
        summary = work.keep(
            texts.mapInArrow(_summaries(id_type, k), f"id {id_sql}, text_hash long, n long, cls long, sketch binary, shingle long, docs long"), "summary")
        rows = summary.where("shingle is null").select("id", "text_hash", "n", "cls", "sketch")
        n_docs = rows.count()
        known = (
            summary.where("shingle is not null").groupBy("shingle").agg(F.sum("docs").alias("docs"))
            .where(F.col("docs") >= max(2, n_docs * FREQUENT_SHARE / 2)).select("shingle").toPandas())
        frequent = spark.sparkContext.broadcast(np.sort(known["shingle"].to_numpy(np.int64).view(np.uint64)))
        classes = work.keep(
            rows.where("cls is not null").groupBy("cls").agg(
                F.min("id").alias("first"), F.max(F.struct("id", "text_hash")).alias("one"), F.count("*").alias("class_size"),
                F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")

        # Keys of several classes are found by a partial minimum and maximum, so a hot key's classes never meet in a task.
        found = work.keep(texts.where("text is not null").mapInArrow(_keys(k, num, den, frequent), "key long, cls long"), "keys")
        several = work.keep(found.groupBy("key").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo != hi").select("key"), "several")
        shared = work.keep(found.join(several, "key").select("key", "cls").distinct(), "shared")
        work.drop(found)
        work.drop(several)
        weight = (
            shared.join(shared.groupBy("key").agg(F.count("*").alias("size")), "key")
            .groupBy("cls").agg(F.sum("size").alias("weight")))
        weighed = shared.join(weight, "cls")
        centres = weighed.groupBy("key").agg(
            F.max(F.struct("weight", "cls")).alias("hub"), F.min(F.struct(F.xxhash64("key", "cls").alias("h"), "cls")).alias("any"))
        pairs = (
            shared.join(centres, "key").select("cls", F.explode(F.array("hub.cls", "any.cls")).alias("centre"))
            .where("cls != centre").select(F.least("cls", "centre").alias("a"), F.greatest("cls", "centre").alias("b")).distinct())
        links = _links(_plausible(pairs, classes, num, den), classes, texts, work, k, num, den)
        labels = work.keep(graph.components(links, work), "labels")

        labelled = shared.join(labels, shared.cls == labels.node, "left").select(
            "key", "cls", F.coalesce("component", "cls").alias("label"))
        mixed = (
            labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size"))
            .where("lo != hi").select("key", F.ceil(F.col("size") / BLOCK).alias("blocks")))
        dealt = (
            labelled.join(mixed, "key").join(classes.select("cls", "n", "sketch"), "cls")
            .withColumn("block", F.pmod(F.xxhash64("cls"), "blocks"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block",
                    "cls", "label", "n", "sketch"))
        crossing = (
            dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
            .mapInArrow(_block_pairs(num, den), "a long, b long").distinct())
        more = _links(crossing, classes, texts, work, k, num, den)
        label = labels.select(F.col("node"), F.col("component"))
        bridges = (
            more.join(label.toDF("a", "la"), "a", "left").join(label.toDF("b", "lb"), "b", "left")
            .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
        joined = work.keep(graph.components(bridges, work), "joined")
        final = (
            classes.select("cls", "first", "class_size").join(labels.toDF("cls", "label"), "cls", "left")
            .withColumn("label", F.coalesce("label", "cls"))
            .join(joined.toDF("label", "top"), "label", "left").withColumn("top", F.coalesce("top", "label")))
        named = final.groupBy("top").agg(F.min("first").alias("component_id"))
        member = work.keep(final.join(named, "top").select("cls", "component_id", "class_size", "top"), "member")
        out = result(
            rows.select("id", "text_hash", "n", "cls").join(member, "cls", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "id").alias("component_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"),
                    "text_hash", F.col("top").alias("component")))
        frequent.destroy()
        return out


@query("op2_ngram_join")
def op2(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), k=4, num=85, den=100)
