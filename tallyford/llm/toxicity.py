"""Toxicity by classifier chains.

Categories are predicted one after the other: each has a linear model on the words of a document and on the
probabilities of the categories before it. In training those earlier probabilities are out-of-fold predictions, so a
model sees them as wrong as they will be: a fold's documents take no part in its models, nor in the choice of the words
these look at. Words and the beginnings of longer words are features by their 64-bit hash and by whether the document has
them; those that the sample associates most with a category are taken.

The categories are the caller's, or they are learned: the words that tell the toxic sample documents from the others are
grouped by spherical k-means, and the toxic documents with a word of one group are a category.

The models are fitted on at most LABELLED labelled documents, the first in the order of a hash of the id; every document
is scored on its whole text, however long. Words are lower-cased runs of letters and digits. Nulls and empty texts have no words and get
the models' intercepts. Null labels and ids are left out, ids labelled several times take the largest labels; several rows of a
labelled id count as one document with the words of all. Equal rows get equal scores. A category with labels of one class only, or
without labels, has probability 0. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import linear
from .decontaminate import normal
from .registry import query, table
from .textscan import Texts, slices
from .work import Work, result

LABELLED = 8000
FEATURES = 192
FOLDS = 4
# Bytes of a word's beginning that are features besides the word.
STEMS = (4, 5, 6)
# Learned categories of toxic documents, and how far a word's count in them is above chance, in standard deviations.
GROUPS = 3
TELLING = 5.0
RIDGE = 0.2
# The threshold is the lowest, but not below LOWEST, at which out-of-fold predictions have this precision.
PRECISION = 0.97
LOWEST = 0.15
# A word counts as a feature if so many sample documents have it.
LEAST_DOCUMENTS = 4


def _words(texts: pa.Array) -> list[np.ndarray]:
    """The distinct words of each text and the first bytes of longer words, which inflected forms share."""
    scanned = Texts(texts)
    values, owners = [scanned.words()], [scanned.text_of_word()]
    for size in STEMS:
        longer = scanned.end - scanned.start > size
        values.append(scanned.ranges(scanned.start[longer], scanned.start[longer] + size) + np.uint64(size))
        owners.append(owners[0][longer])
    value, owner = np.concatenate(values), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    value, bounds = value[order], np.searchsorted(owner[order], np.arange(scanned.n + 1))
    return [np.unique(value[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def select(docs: list[np.ndarray], labels: np.ndarray, most: int) -> np.ndarray:
    """Hashes of the words most associated with any label: by the signed root of chi squared, positive side first."""
    flat = np.concatenate(docs) if docs else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    value, which, df = np.unique(flat, return_inverse=True, return_counts=True)
    best = np.zeros(len(value))
    for y in labels.T:
        total = y.sum()
        if 0 < total < len(y):
            with_label = np.bincount(which, weights=y[owner], minlength=len(value))
            expected = df * total / len(y)
            best = np.maximum(best, np.abs(with_label - expected) / np.sqrt(expected * (1 - total / len(y)) + 1))
    best[df < LEAST_DOCUMENTS] = 0
    order = np.argsort(-best, kind="stable")[:most]
    return np.sort(value[order[best[order] > 0]])


def presence(docs: list[np.ndarray], chosen: np.ndarray) -> np.ndarray:
    x = np.zeros((len(docs), len(chosen)))
    for i, words in enumerate(docs):
        if len(chosen) and len(words):
            at = np.minimum(np.searchsorted(words, chosen), len(words) - 1)
            x[i] = words[at] == chosen
    return x


def grouped(docs: list[np.ndarray], toxic: np.ndarray, k: int) -> np.ndarray:
    """A column of 0 and 1 for each of k categories of the toxic documents; a document may be in several, or in none.

    The words that toxic documents have far more often than others are grouped by the toxic documents that have them, with
    spherical k-means, and a category is the toxic documents with a word of its group. The first centre is the word next
    to the mean, each further one the word furthest from those before. Categories go from the largest to the smallest.
    """
    out = np.zeros((len(docs), k))
    x = presence(docs, select(docs, toxic[:, None], FEATURES))
    total = toxic.sum()
    expected = x.sum(0) * total / max(1, len(docs))
    telling = (toxic @ x - expected) / np.sqrt(expected * (1 - total / max(1, len(docs))) + 1) >= TELLING
    rows = np.flatnonzero(toxic > 0)
    if not telling.any():
        return out
    has = x[np.ix_(rows, np.flatnonzero(telling))]
    own = (has / np.linalg.norm(has, axis=0)).T
    at = [int(np.argmax(np.round(own @ own.sum(0), 9)))]
    while len(at) < min(k, len(own)):
        at.append(int(np.argmin(np.round((own @ own[at].T).max(1), 9))))
    centres = own[at]
    for _ in range(20):
        group = np.argmax(np.round(own @ centres.T, 9), axis=1)
        sums = np.stack([own[group == g].sum(0) if (group == g).any() else centres[g] for g in range(len(centres))])
        moved = sums / np.linalg.norm(sums, axis=1, keepdims=True)
        if np.allclose(moved, centres, atol=1e-9):
            break
        centres = moved
    found = np.stack([has[:, group == g].any(1) for g in range(len(centres))], axis=1)
    out[rows, :len(centres)] = found[:, np.argsort(-found.sum(0), kind="stable")]
    return out


class Chain:
    """Linear models in a row; a model is None where its category has labels of one class.

    `chosen` are the words that the models on all documents look at, `out` the out-of-fold probabilities.
    """

    def __init__(self, docs: list[np.ndarray], labels: np.ndarray, fold: np.ndarray):
        self.models: list[np.ndarray | None] = []
        self.chosen = select(docs, labels, FEATURES)
        x, folds = presence(docs, self.chosen), []
        for f in np.unique(fold):
            inside = fold != f
            seen = select([d for d, i in zip(docs, inside) if i], labels[inside], FEATURES)
            folds.append((inside, presence(docs, seen)))
        earlier = np.zeros((len(docs), 0))
        for y in labels.T:
            out = np.zeros(len(docs))
            if not 0 < y.sum() < len(y):
                self.models.append(None)
                earlier = np.column_stack((earlier, out))
                continue
            for inside, seen in folds:
                full = np.column_stack((seen, earlier))
                some = linear.fit(full[inside], y[inside], ridge=RIDGE) if 0 < y[inside].sum() < inside.sum() else None
                out[~inside] = linear.predict(some, full[~inside]) if some is not None else y[inside].mean()
            self.models.append(linear.fit(np.column_stack((x, earlier)), y, ridge=RIDGE))
            earlier = np.column_stack((earlier, out))
        self.out = earlier
        order = np.argsort(-earlier[:, -1], kind="stable")
        p = earlier[order, -1]
        right = np.cumsum(labels[order, -1]) / np.arange(1, len(p) + 1)
        good = p[(right >= PRECISION) & (p >= LOWEST)]
        self.threshold = float(round(good[-1], 6)) if len(good) else 0.5

    def predict(self, x: np.ndarray) -> np.ndarray:
        earlier = np.zeros((len(x), 0))
        for w in self.models:
            p = linear.predict(w, np.column_stack((x, earlier))) if w is not None else np.zeros(len(x))
            earlier = np.column_stack((earlier, p))
        return earlier


def _sample(categories: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.record_batch([batch.column("id"), pa.array([w.tobytes() for w in _words(batch.column("text"))], pa.binary()),
                                   *[batch.column(c) for c in categories]], ["id", "words", *categories])

    return run


def _score(model, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = model.value
        for batch in slices(batches):
            found = chain.predict(presence(_words(batch.column("text")), chain.chosen)) if chain is not None else np.zeros((batch.num_rows, len(names)))
            yield pa.record_batch([batch.column("id"), *[pa.array(np.round(found[:, i], 9)) for i in range(len(names))]], ["id", *names])

    return run


def scored(
    docs: DataFrame, labels: DataFrame, categories: dict[str, Column | None] | None = None, *, id_col: str = "doc_id",
    text_col: str = "text", toxic_col: str = "toxic", threshold: float | None = None, labelled: int = LABELLED, groups: int = GROUPS,
) -> DataFrame:
    """Per document `(id_col, p_<category>..., toxic)`; the chain follows `categories`, the last decides.

    Without categories they are `group_1`, ..., learned from the toxic documents, the largest first, and then `toxic`.

    A document is toxic if the last probability reaches `threshold`; without one it is chosen on out-of-fold predictions.
    A category is a condition on the words of a toxic document (column `text`), which gives its training labels, or
    None: the label column itself.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), normal(F.col(text_col)).alias("text"))
    id_sql = dict(rows.dtypes)["id"]
    given = {"toxic": None} if categories is None else categories
    names = list(given) if categories is not None else [f"group_{i + 1}" for i in range(groups)] + ["toxic"]
    known = labels.where(F.col(id_col).isNotNull() & F.col(toxic_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.col(toxic_col).cast("int")).alias("label"))
    with Work(spark, "toxicity") as work:
        present = rows.select("id").distinct()
        sample = work.keep(linear.first_by_hash(known.join(present, "id"), "id", labelled).coalesce(1), "sample")
        labelled_rows = rows.join(sample, "id").select("id", "text", *[
            (F.col("label") == 1 if rule is None else (F.col("label") == 1) & F.coalesce(rule, F.lit(False))).cast("int").alias(name)
            for name, rule in given.items()])
        got = _one_per_id(labelled_rows.mapInArrow(_sample(list(given)), f"id {id_sql}, words binary, " + ", ".join(f"{c} int" for c in given)), list(given))
        ids = sorted(got)
        words = [got[i][0] for i in ids]
        y = np.array([got[i][1] for i in ids], np.float64).reshape(len(ids), len(given))
        chain = None
        if y.any() and not y.all():
            if categories is None:
                y = np.column_stack((grouped(words, y[:, -1], groups), y))
            chain = Chain(words, y, np.array([zlib.crc32(f"fold:{i}".encode()) % FOLDS for i in ids]))
        model = spark.sparkContext.broadcast(chain)
        if threshold is None:
            threshold = chain.threshold if chain is not None else 0.5
        found = rows.mapInArrow(_score(model, names), f"id {id_sql}, " + ", ".join(f"{c} double" for c in names))
        return result(found.select(
            F.col("id").alias(id_col), *[F.col(c).alias(f"p_{c}") for c in names], (F.col(names[-1]) >= threshold).alias("toxic")))


def _one_per_id(found: DataFrame, names: list[str]) -> dict[str, tuple[np.ndarray, list[int]]]:
    """Words and labels of the labelled ids, brought to the driver: one row for each id and, of rows that share it, text."""
    out: dict[str, tuple[np.ndarray, list[int]]] = {}
    for row in found.distinct().toArrow().to_pylist():
        name, words, y = str(row["id"]), np.frombuffer(row["words"], np.uint64), [row[c] for c in names]
        if name in out:
            words, y = np.union1d(words, out[name][0]), [max(a, b) for a, b in zip(y, out[name][1])]
        out[name] = words, y
    return out


def has_word(*words: str) -> Column:
    """A category's rule: the text has one of the words."""
    return F.rlike("text", F.lit(rf"\b({'|'.join(words)})\b"))


@query("op8_toxicity")
def op8(spark, sf_dir):
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
