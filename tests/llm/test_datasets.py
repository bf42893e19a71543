"""The manifest, the search and the shards against brute force, on odd rows and on empty tables."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import oracle
from tallyford.llm import merkle, order, search, sharding
from tallyford.llm.queries import QUERIES, SQL
from tallyford.llm.registry import ship
from tallyford.llm.work import Work

random.seed(11)
NOUNS = ["".join(random.choices("abcdefghij", k=random.randint(2, 6))) for _ in range(120)]
COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def prose(n):
    return " ".join(random.choices(NOUNS, k=n))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    copy, long = prose(40), prose(30_000)
    odd = [
        (None, None, None, None, None), (None, None, None, None, None), (1, "a", "en", 3, "x\ny"), (1, "a", "en", 3, "x\ny"), (2, "a", None, None, ""),
        (3, None, "en", 7, "Ünï\n\ncödé 😀 A-Z b9"), (4, "", "en", 0, " \n"), (5, "z", "en", 1, long), (6, "z", "en", 1, long + "\nend"), (7, "only", "en", 1, copy)]
    many = [(100 + i, "hot", "en", i, copy if i % 3 else prose(i % 50)) for i in range(90)]
    return odd + many


@pytest.fixture(scope="module")
def docs(spark, rows):
    ship(spark)
    clash = ["shard", "slot", "idx", "n", "digest", "path", "block", "row", "tie", "items", "score"]
    return spark.createDataFrame(rows, COLUMNS).repartition(5).withColumns({c: F.lit(c) for c in clash})


def brute_leaf(row, text):
    doc_id, source, lang, n_chars, _ = row
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(leaves, fan):
    """The root, and for each leaf its siblings (left, right) per level."""
    paths, nodes = [[] for _ in leaves], [(d, [i]) for i, d in enumerate(leaves)]
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), fan):
            run = nodes[at:at + fan]
            for j, (_, members) in enumerate(run):
                for i in members:
                    paths[i].append(("".join(d for d, _ in run[:j]), "".join(d for d, _ in run[j + 1:])))
            above.append((sha("".join(d for d, _ in run)), [i for _, m in run for i in m]))
        nodes = above
    return nodes[0][0], paths


@pytest.mark.parametrize("fan, depth", [(3, 6), (3, 1), (2, 2), (4, 2)])
def test_merkle(spark, docs, rows, fan, depth):
    with Work(spark, "test") as work:
        made = merkle.manifest(docs, work, fan=fan, depth=depth, more={"seen": F.col("text")}).withColumns({
            "folded": merkle.fold(F.col("leaf"), F.col("path")), "proof": merkle.proof_digest(F.col("path"))}).collect()
    by_source = collections.defaultdict(list)
    for row in rows:
        by_source[row[1]].append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees, want = {}, []
    for name in names:
        members = sorted((r[0] is not None, r[0] or 0, brute_leaf(r, r[4]), r) for r in by_source[name])
        trees[name] = members, *climb([m[2] for m in members], fan)
    root, tops = climb([trees[name][1] for name in names], fan)
    for name, top in zip(names, tops):
        members, subroot, paths = trees[name]
        for place, ((*_, leaf, row), path) in enumerate(zip(members, paths)):
            want.append((row[0], name, place, leaf, subroot, root, [*path, *top], row[4]))
    got = [(r.id, r.source, r.position, r.leaf, r.subroot, r.root, [tuple(p) for p in r.path], r.seen) for r in made]
    key = lambda r: (str(r[1]), r[2])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r.folded for r in made} == {root}
    assert all(r.proof == sha("".join(a + b for a, b in r.path)) for r in made)


def test_merkle_finds_changes(spark, docs):
    with Work(spark, "test") as work:
        made = merkle.manifest(docs, work, more={"other": merkle.leaf(F.col("doc_id"), F.col("source"))})
        assert made.where(merkle.fold(F.col("other"), F.col("path")) == F.col("root")).count() == 0
        empty = docs.limit(0)
        assert merkle.manifest(empty, work).count() == 0
        one = merkle.manifest(docs.where("doc_id = 7"), work).first()
        assert one.leaf == one.subroot == one.root and one.path == []


def test_numbered(spark):
    frame = spark.range(1000).select((F.col("id") % 7).alias("g"), (F.col("id") % 10).alias("o"), "id").repartition(7)
    with Work(spark, "test") as work:
        got = order.numbered(frame, ["g"], ["o", "id"], work).collect()
    want = sorted((r.g, r.o, r.id) for r in got)
    assert [(r.g, r.o, r.id) for r in sorted(got, key=lambda r: (r.g, r.idx))] == want
    assert all(sorted(r.idx for r in got if r.g == g) == list(range(n)) for g, n in collections.Counter(r.g for r in got).items())
    assert {(r.g, r.n) for r in got} == set(collections.Counter(r.g for r in got).items())


def md5(text):
    return 0 if text is None else int(hashlib.md5(text.encode()).hexdigest()[:sharding.HASH_DIGITS], 16)


def brute_shards(rows, shards, tolerance):
    """Multiset of (id, size, checksum, shard), and sizes; equal rows are not told apart."""
    keyed = sorted((md5(r[4]), md5(None if r[0] is None else str(r[0])), i) for i, r in enumerate(rows))
    size = {i: len((r[4] or "").encode()) + 8 for i, r in enumerate(rows)}
    total, before, places, groups = sum(size.values()), 0, [], {}
    for k, _, i in keyed:
        low, high = groups.get(k, (before, before))
        groups[k] = low, before + size[i]
        places.append((before, before + size[i], k, i))
        before += size[i]
    cuts = []
    for goal in range(1, shards):
        low, high, k, _ = next(p for p in places if p[0] * shards < goal * total <= p[1] * shards)
        a, b = groups[k]
        if min(goal * total - a * shards, b * shards - goal * total) <= total * tolerance:
            low, high = a, b
        cuts.append(low if goal * total - low * shards < high * shards - goal * total else high)
    return sorted((str(rows[i][0]), size[i], zlib.crc32((rows[i][4] or "").encode()), sum(c <= low for c in cuts)) for low, _, _, i in places)


@pytest.mark.parametrize("shards, tolerance, probes", [(24, 0.005, 4096), (5, 0.2, 4096), (3, 0.0, 7), (1, 0.0, 4096), (200, 0.005, 64)])
def test_shards(spark, docs, rows, shards, tolerance, probes, monkeypatch):
    monkeypatch.setattr(sharding, "PROBES", probes)
    with Work(spark, "test") as work:
        got = sharding.sharded(docs, work, shards, tolerance=tolerance).collect()
    assert sorted((str(r.row.doc_id), r.size, r.text_crc32, r.shard) for r in got) == brute_shards(rows, shards, tolerance)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {r.row.shard for r in got} == {"shard"}


def test_shards_are_even_with_a_hot_group(spark):
    text = prose(30)
    rows = [(i, "a", "en", 1, text if i % 3 == 0 else prose(30)) for i in range(3000)] + [(None, "a", "en", 1, text)] * 500
    docs = spark.createDataFrame(rows, COLUMNS).repartition(4)
    with Work(spark, "test") as work:
        sizes = [r["sum(size)"] for r in sharding.sharded(docs, work, 24).groupBy("shard").sum("size").collect()]
        assert len(sizes) == 24 and max(sizes) < 1.03 * min(sizes)
        assert sharding.sharded(docs.limit(0), work, 24).count() == 0


def test_written_shards(spark, docs, rows, tmp_path):
    with Work(spark, "test") as work:
        sharding.write_shards(docs.drop("shard", "slot"), str(tmp_path / "out"), work, 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows) and {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}


def brute_search(rows, items, k):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    counted = [(doc, collections.Counter(terms(text))) for doc, text in rows]
    counted = [(doc, c) for doc, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = collections.Counter(itertools.chain.from_iterable(c for _, c in counted))
    out = []
    for item, text in items:
        found = []
        for doc, c in counted:
            m = 10 + (90 * sum(c.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, *_, doc) in enumerate(sorted(found)[:k], 1)]
    return collections.Counter(out)


ITEMS = [(1, NOUNS[3] + " " + NOUNS[5].upper() + ", " + prose(20)), (2, None), (3, ""), (4, "no-such-word 9z9"), (5, prose(300)), (5, NOUNS[1]), (None, "ünï b9")]


@pytest.mark.parametrize("block, group, owners, k", [(8192, 256, (0.01, 0.1), 10), (7, 2, (0.02, 0.3, 0.6), 3), (16, 256, (0.2,), 1)])
def test_search(spark, docs, rows, block, group, owners, k, monkeypatch):
    import tallyford.llm.search as module
    monkeypatch.setattr(module, "BLOCK_DOCS", block)
    monkeypatch.setattr(module, "OWNERS", owners)
    monkeypatch.setattr(module, "GROUP_ITEMS", group)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("score", F.lit("x")).repartition(2)
    with Work(spark, "test") as work:
        got = search.search(docs, items, work, k).collect()
        assert search.search(docs.limit(0), items, work, k).count() == 0
        assert search.search(docs, items.limit(0), work, k).count() == 0
    assert collections.Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == brute_search([(r[0], r[4]) for r in rows], ITEMS, k)


@pytest.mark.parametrize("name", ["op11_lexical_search", "op12_merkle_manifest", "op13_sharding"])
def test_query(spark, sf_dir, name):
    assert oracle.difference(QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), SQL[name]) is None
