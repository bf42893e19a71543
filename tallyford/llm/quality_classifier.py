"""Quality classifier by co-training of a text view and a metadata view.

The text view sees the text only (shares of symbols, capitals, digits, repeated words and lines, word lengths, hashed
words); the metadata view sees language, source and length only. Both are linear classifiers. They are fitted on at
most LABELLED labelled documents; in each round every view labels all unlabelled documents and hands the ones it
is surest of, in the proportion of the classes, to the other view's training rows. Tasks count the scores and sum the
slopes and curvatures of the handed documents, so the driver holds sums of fixed size. A fifth of the labelled documents stays
out of training: on it each view is calibrated and the two are combined. Then every document is scored.

A document is kept if its score is at least `threshold`. The labelled sample is the first rows in the order
of a hash of the id, LABELLED at most; nothing else is bounded. Documents with a null id are unlabelled. Null texts, languages, sources and lengths are values like
others, an empty text has no words. A label that is null is none; ids labelled several times take the largest label.
Equal rows get equal scores. With labels of one class only, or none, all scores are 1 and all documents are kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import linear
from .quality_rules import repeated_lines
from .registry import query, table
from .textscan import Texts, mix, slices
from .work import Work, result

LABELLED = 8000
ROUNDS = 4
# Documents that a view hands over in a round, as a share of the unlabelled ones.
HANDED = 0.05
PRECISION = 0.95
THRESHOLD = 0.5
HASHED = 96
SOURCES = 64
# Steps of a score in which documents are counted, from REACH below 0 to REACH above.
BINS = 4096
REACH = 30
# Tasks whose sums are added before they go to the driver.
ADDED = 16

_CLASS = {name: np.zeros(256, bool) for name in ("upper", "digit", "symbol", "letter", "bar", "loud")}
_CLASS["upper"][65:91] = _CLASS["digit"][48:58] = True
_CLASS["letter"][[*range(65, 91), *range(97, 123), *range(0xC3, 0x100)]] = True
_CLASS["symbol"][[ord(c) for c in "#*$%&<>@{}[]^~=_\\/"]] = True
_CLASS["bar"][ord("|")] = _CLASS["loud"][[ord("!"), ord("?")]] = True


def text_view(texts: pa.Array) -> np.ndarray:
    """Shares per text: characters of some classes, repeated and very long words, repeated lines, hashed words."""
    scanned = Texts(texts, lower=False)
    n, words = np.maximum(np.diff(scanned.first), 1), scanned.words()
    bounds, of = scanned.first, scanned.text_of_word()
    columns = [np.log1p(np.diff(bounds))]

    def per_word(values: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=values, minlength=scanned.n) / n

    for members in _CLASS.values():
        sums = np.concatenate(([0], np.cumsum(members[scanned.raw], dtype=np.int64)))
        inside = sums[scanned.end] - sums[scanned.start]
        columns += [per_word(inside > 0), per_word(inside / np.maximum(scanned.end - scanned.start, 1))]
    long = scanned.end - scanned.start
    columns += [per_word(long), per_word(long > 25), per_word(long == 1)]
    same = np.concatenate(([False], (words[1:] == words[:-1]) & (of[1:] == of[:-1]))) if len(words) else np.zeros(0, bool)
    columns.append(per_word(same))
    distinct, top = np.ones(scanned.n), np.zeros(scanned.n)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if b > a:
            counts = np.unique(words[a:b], return_counts=True)[1]
            # A long text repeats words anyway: compare with what its length lets expect.
            distinct[i], top[i] = np.log(len(counts)) / np.log(b - a + 1), counts.max() / (b - a)
    columns += [distinct, top, repeated_lines(scanned) / n]
    folded = Texts(texts).words()
    bucket = (mix(folded) % np.uint64(HASHED)).astype(np.int64)
    hashed = np.bincount(of * HASHED + bucket, minlength=scanned.n * HASHED).reshape(scanned.n, HASHED) / n[:, None]
    return np.column_stack((*columns, np.sqrt(hashed))).astype(np.float32)


def metadata_view(language: list, source: list, length: list) -> np.ndarray:
    """Indicators of language and source by hash, and the length in steps."""
    out = np.zeros((len(language), 16 + SOURCES + 20), np.float32)
    for i, (a, b, c) in enumerate(zip(language, source, length)):
        out[i, zlib.crc32(repr(a).encode()) % 16] = 1
        out[i, 16 + zlib.crc32(repr(b).encode()) % SOURCES] = 1
        out[i, 16 + SOURCES + (0 if c is None else min(19, 1 + max(int(c), 0).bit_length()))] = 1
    return out


class Scaled:
    """Features brought to mean 0 and deviation 1, cut at 6 deviations."""

    def __init__(self, n: int, total: np.ndarray, squares: np.ndarray):
        self.mean = total / n
        self.scale = np.sqrt(np.maximum(squares / n - self.mean ** 2, 0)) + 1e-3

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)


def surely(p: np.ndarray, y: np.ndarray, label: int) -> float:
    """The lowest confidence from which on a view's label is right with PRECISION; over 1 if none.

    The share of right labels among the checked documents counts by its lower 95 % bound (Wilson).
    """
    sure = p if label else 1 - p
    order = np.argsort(-sure, kind="stable")
    n, z = np.arange(1, len(y) + 1), 1.64
    right = np.cumsum(y[order] == label) / n
    lower = (right + z * z / (2 * n) - z * np.sqrt(right * (1 - right) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    good = np.flatnonzero(lower >= PRECISION)
    return float(sure[order][good[-1]]) if len(good) else 2.0


def _bin(z: np.ndarray) -> np.ndarray:
    return np.rint((np.clip(z, -REACH, REACH) + REACH) * ((BINS - 1) / (2 * REACH))).astype(np.int64)


def _edge(counts: np.ndarray, least: float, wanted: int) -> tuple[int, float]:
    """Where the surest `wanted` end: the last step, and the share of its documents; `counts` from unsure to sure."""
    if least > 1:
        return BINS, 0.0
    least = int(_bin(np.array(REACH if least == 1 else np.log(max(least, 1e-300) / (1 - least)))))
    total = np.cumsum(counts[least:][::-1])
    if total[-1] <= wanted:
        return least, 1.0
    i = int(np.searchsorted(total, wanted))
    at = BINS - 1 - i
    return at, float(wanted - (total[i] - counts[at])) / float(counts[at])


def handed_over(history: list, views: list[np.ndarray], draw: np.ndarray) -> list[np.ndarray]:
    """For each view the labels that it was handed in the rounds so far, -1 for none.

    A round is the weights of both views and, for each teacher, the edges of label 1 and 0; `draw` is a hash that decides at
    an edge, anew in each round.
    """
    labels = [np.full(len(draw), -1, np.int64) for _ in views]
    for turn, (weights, rules) in enumerate(history):
        for teacher, ((one, one_share), (zero, zero_share)) in enumerate(rules):
            step = _bin(views[teacher] @ weights[teacher][:-1] + weights[teacher][-1])
            mine = labels[1 - teacher]
            for label, at, edge, share in ((1, step, one, one_share), (0, BINS - 1 - step, zero, zero_share)):
                drawn = mix(draw + np.uint64(2 * turn + label + 1)) / 2.0 ** 64
                mine[(mine < 0) & ((at > edge) | ((at == edge) & (drawn < share)))] = label
    return labels


def derivatives(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Loss, slope and curvature of a logistic fit on these rows, in one array."""
    x = np.column_stack((x, np.ones(len(x)))).astype(np.float64)
    z = x @ w
    p = linear.sigmoid(z)
    return np.concatenate((
        [(np.logaddexp(0, z) - y * z).sum()], x.T @ (p - y), ((x * (p * (1 - p) + 1e-6)[:, None]).T @ x).ravel()))


def refitted(weights: list[np.ndarray], sums, ridge: float = 3.0, steps: int = 12) -> list[np.ndarray]:
    """The weights of both views after Newton steps; `sums(weights)` has each view's derivatives over all its rows."""
    shrink = [np.append(np.full(len(w) - 1, ridge), 1e-6) for w in weights]
    best: list = [None, None]
    tried, change = list(weights), [np.zeros(len(w)) for w in weights]
    done, halved = [False, False], [0, 0]
    for _ in range(2 * steps):
        found = sums(tried)
        for v, (r, w) in enumerate(zip(shrink, tried)):
            if done[v]:
                continue
            d = len(w)
            loss = found[v][0] + (r * w * w).sum() / 2
            if best[v] is not None and loss > best[v][0] and halved[v] < 20:
                # A full step can go too far where the classes are apart.
                change[v], halved[v] = change[v] / 2, halved[v] + 1
                tried[v] = best[v][1] - change[v]
                continue
            gain = np.inf if best[v] is None else best[v][0] - loss
            best[v] = (loss, w)
            done[v] = gain < 1e-6 * max(1.0, loss)
            change[v] = np.linalg.solve(found[v][1 + d:].reshape(d, d) + np.diag(r), found[v][1:1 + d] + r * w)
            tried[v], halved[v] = (w if done[v] else w - change[v]), 0
        if all(done):
            break
    return [b[1] for b in best]


class Unlabelled:
    """The features of all unlabelled documents, a kept table `(draw, text, meta)`, summed by the tasks."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    def summed(self, per_batch) -> np.ndarray | float:
        """The sum of `per_batch(views, draw)` over all batches; 0 without documents."""
        def add(arrays):
            total = sum(arrays)
            return None if isinstance(total, int) else total

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = add(per_batch(_unpacked(b), _draw(b.column("draw"))) for b in batches if b.num_rows)
            if total is not None:
                yield pa.record_batch([pa.array([TaskContext.get().partitionId() % ADDED], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "sums"])

        def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = add(np.frombuffer(x, np.float64) for b in batches for x in b.column("sums").to_pylist())
            if total is not None:
                yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["sums"])

        found = self.rows.mapInArrow(run, "part int, sums binary").repartition(ADDED, "part").select("sums").mapInArrow(again, "sums binary").collect()
        return sum((np.frombuffer(r.sums, np.float64) for r in found), 0.0)

    def moments(self):
        return self.summed(lambda views, _: np.concatenate([[len(_)], *[f(x) for x in views for f in (_total, _squares)]]))

    def counts(self, scale, history, weights):
        """For each teacher how many documents its pupil was not handed yet have each score."""
        def per_batch(views, draw):
            views = [f(x) for f, x in zip(scale, views)]
            labels = handed_over(history, views, draw)
            return np.concatenate([
                np.bincount(_bin(v @ w[:-1] + w[-1])[labels[1 - t] < 0], minlength=BINS) for t, (v, w) in enumerate(zip(views, weights))]).astype(float)

        return self.summed(per_batch)

    def derivatives(self, scale, history, weights):
        def per_batch(views, draw):
            views = [f(x) for f, x in zip(scale, views)]
            labels = handed_over(history, views, draw)
            return np.concatenate([derivatives(x[y >= 0], y[y >= 0], w) for x, y, w in zip(views, labels, weights)])

        return self.summed(per_batch)


def _total(x: np.ndarray) -> np.ndarray:
    return x.sum(0, dtype=np.float64)


def _squares(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.float64) ** 2).sum(0)


def _draw(hashes) -> np.ndarray:
    return hashes.to_numpy().view(np.uint64)


def _unpacked(rows) -> list[np.ndarray]:
    """The two views of rows of `_features`."""
    n = rows.num_rows
    text, meta = (b"".join(rows.column(c).to_pylist()) for c in ("text", "meta"))
    return [np.frombuffer(text, np.float32).reshape(n, -1), np.frombuffer(meta, np.uint8).reshape(n, -1).astype(np.float32)]


def co_train(
    views: list[np.ndarray], y: np.ndarray, others: Unlabelled, n_others: int, scale: list[Scaled], check: list[np.ndarray], check_y: np.ndarray,
    rounds: int = ROUNDS, handed: float = HANDED,
) -> list[np.ndarray]:
    """Weights of the two views after they taught each other on all unlabelled documents.

    A view hands over only labels of a confidence that was right on the checked documents, so a view that knows
    nothing teaches nothing.
    """
    history: list = []
    weights = [linear.fit(v, y, ridge=3.0) for v in views]

    def sums(tried):
        there = others.derivatives(scale, history, tried)
        ends = np.cumsum([1 + len(w) + len(w) ** 2 for w in tried])[:-1]
        return [derivatives(v, y, w) + more for v, w, more in zip(views, tried, np.split(there, ends))]

    for _ in range(rounds if n_others else 0):
        counts = others.counts(scale, history, weights).reshape(2, BINS)
        rules = []
        for teacher in (0, 1):
            checked = linear.predict(weights[teacher], check[teacher])
            wanted = [int(np.ceil(handed * n_others * share)) for share in (1 - y.mean(), y.mean())]
            one = _edge(counts[teacher], surely(checked, check_y, 1), wanted[1])
            free = counts[teacher].copy()
            free[one[0] + 1:] = 0
            if one[0] < BINS:
                free[one[0]] *= 1 - one[1]
            rules.append((one, _edge(free[::-1], surely(checked, check_y, 0), wanted[0])))
        history.append((weights, rules))
        weights = refitted(weights, sums)
    return weights


class Model:
    """Two views, their scaling and their calibrated combination."""

    def __init__(self, text: np.ndarray, meta: np.ndarray, label: np.ndarray, held: np.ndarray, others: Unlabelled):
        moments = np.concatenate([[len(label)], *[f(x) for x in (text, meta) for f in (_total, _squares)]])
        more = others.moments()
        moments = moments + more
        parts = np.split(moments[1:], np.cumsum([text.shape[1], text.shape[1], meta.shape[1]]))
        self.scale = [Scaled(moments[0], *parts[:2]), Scaled(moments[0], *parts[2:])]
        views = [s(x) for s, x in zip(self.scale, (text, meta))]
        train, check = ~held, held
        if len(set(label[check])) < 2:
            train = check = np.ones(len(label), bool)
        self.weights = co_train(
            [v[train] for v in views], label[train], others, int(moments[0]) - len(label), self.scale, [v[check] for v in views], label[check])
        margins = [v[check] @ w[:-1] + w[-1] for v, w in zip(views, self.weights)]
        # Platt's calibration of each view, then one linear combination of the calibrated margins.
        self.platt = [linear.fit(m[:, None], label[check], ridge=1e-3) for m in margins]
        calibrated = np.column_stack([linear.logit(linear.predict(c, m[:, None])) for c, m in zip(self.platt, margins)])
        self.joint = linear.fit(calibrated, label[check], ridge=1.0)

    def score(self, text: np.ndarray, meta: np.ndarray) -> list[np.ndarray]:
        """Calibrated probability of good quality: by text, by metadata, combined."""
        views = []
        for s, w, c, x in zip(self.scale, self.weights, self.platt, (text, meta)):
            views.append(linear.predict(c, (s(x) @ w[:-1] + w[-1])[:, None]))
        return [*views, linear.predict(self.joint, np.column_stack([linear.logit(v) for v in views]))]


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return text_view(batch.column("text")), metadata_view(*[batch.column(c).to_pylist() for c in ("language", "source", "length")])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        text, meta = _views(batch)
        yield pa.record_batch([batch.column("id"), batch.column("draw"), pa.array([r.tobytes() for r in text], pa.binary()),
                               pa.array([r.tobytes() for r in meta.astype(np.uint8)], pa.binary())], ["id", "draw", "text", "meta"])


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = model.value.score(*_views(batch)) if model.value is not None else [np.ones(batch.num_rows)] * 3
            rest = [c for c in batch.schema.names if c not in ("language", "source", "length", "text")]
            yield pa.record_batch([*[batch.column(c) for c in rest], *[pa.array(np.round(f, 9)) for f in found]],
                                  [*rest, "text_score", "meta_score", "score"])

    return run


def train(docs: DataFrame, labels: DataFrame, work: Work, *, id_col: str, label_col: str, labelled: int) -> Model | None:
    """A model from labelled documents; `docs` has the columns id, text, language, source and length."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.col(label_col).cast("int")).alias("label"))
    present = docs.select("id").where("id is not null").distinct()
    some = work.keep(linear.first_by_hash(known.join(present, "id"), "id", labelled).coalesce(1), "sample")
    if some.select("label").distinct().count() < 2:
        return None
    id_sql = dict(docs.dtypes)["id"]
    # Two scans of the texts: the few labelled ones go to the driver, the features of the others stay in the shared folder.
    rows = docs.withColumn("draw", F.xxhash64("id", "text"))
    features = f"id {id_sql}, draw long, text binary, meta binary"
    rest = work.keep(rows.mapInArrow(_features, features).join(known, "id", "left_anti").select("draw", "text", "meta"), "unlabelled")
    rows = rows.join(some.select("id"), "id").mapInArrow(_features, features).join(some, "id").toArrow().combine_chunks()
    label = rows["label"].to_numpy().astype(np.int64)
    ids = [str(x) for x in rows["id"].to_pylist()]
    order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], label[i])))
    views = [v[order] for v in _unpacked(rows)]
    held = np.array([zlib.crc32(f"held:{ids[i]}".encode()) % 5 == 0 for i in order])
    return Model(*views, label[order], held, Unlabelled(rest))


def scored(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", language_col: str = "lang",
    source_col: str = "source", length_col: str = "n_chars", label_col: str = "quality", threshold: float = THRESHOLD,
    labelled: int = LABELLED,
) -> DataFrame:
    """Per document `(id_col, text_score, meta_score, score, kept)`: calibrated probabilities of good quality."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(language_col).cast("string").alias("language"),
        F.col(source_col).cast("string").alias("source"), F.col(length_col).cast("long").alias("length"))
    id_sql = dict(rows.dtypes)["id"]
    with Work(spark, "quality-classifier") as work:
        model = spark.sparkContext.broadcast(train(rows, labels, work, id_col=id_col, label_col=label_col, labelled=labelled))
        found = rows.mapInArrow(_score(model), f"id {id_sql}, text_score double, meta_score double, score double")
        return result(found.withColumn("kept", F.col("score") >= threshold).withColumnRenamed("id", id_col))


def keep(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", language_col: str = "lang",
    source_col: str = "source", length_col: str = "n_chars", label_col: str = "quality", threshold: float = THRESHOLD,
    labelled: int = LABELLED,
) -> DataFrame:
    """The documents that are kept, with all their columns."""
    spark = docs.sparkSession
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"),
        F.col(language_col).cast("string").alias("language"), F.col(source_col).cast("string").alias("source"),
        F.col(length_col).cast("long").alias("length"))
    with Work(spark, "quality-classifier") as work:
        plain = rows.select(F.col(f"row.`{id_col}`").alias("id"), "text", "language", "source", "length")
        model = spark.sparkContext.broadcast(train(plain, labels, work, id_col=id_col, label_col=label_col, labelled=labelled))
    schema = rows.select("row").schema.add("text_score", "double").add("meta_score", "double").add("score", "double")
    return rows.mapInArrow(_score(model), schema).where(F.col("score") >= threshold).select("row.*")


@query("op7_quality_classifier")
def op7(spark, sf_dir):
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
