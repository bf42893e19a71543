"""Language-model scores by logistic mixing of context bit predictors.

Tokens are the lower-cased (A-Z) words of a text and one end. A token is predicted in two parts: the bits of its 8-bit
code (four bits from its first letters, four from its last), one after the other, and the token among those of its code by
counts. Each bit is predicted by several tables that count codes by context: no context, the code before, the token
before, the two codes before. The predictions are combined in the logistic domain with weights
that a gate selects (bit number, how often the token before was seen), then refined by an adaptive map from the
mixed probability to the observed one. The result is a probability of the whole text; `bits_per_byte` is its cost.

Every context has counts of its own, so what is gathered grows with the corpus. The codes before are at most 2^16 contexts, which
are sent to the tasks. The tokens before are kept in buckets by their hash, about `BUCKET_TOKENS` training tokens to a bucket.

Passes over the training texts and all texts:
1. Count tokens and, for each token before, the (two codes before, code) that follow. Equal training tokens are one entry with its
   number from here on.
2. In each bucket, in the order of the hashes, run the mixer online over the entries, with one of each entry's own counts taken out.
   A bucket's weights count by their use. Buckets and their order come from the corpus alone, and sums are of whole numbers, so the
   model does not depend on how the input is split.
3. Score all texts. Contexts that make up at least one in 2^15 of the training tokens, at most 2^15 by that
   definition, are sent to the tasks. All other tokens go, packed by the thousand, to their context's bucket; there each
   distinct (context, two codes, code) is looked up and scored once, and each pack brings its documents' sums back.
The tokens that make up at least one in 2^22 of the training tokens, at most 2^22 by that definition, are sent to the tasks;
the counts of others come by a join on the token.

A null text is empty and has the end only. A null id is not held out. Texts may be of any length. Rows are scored one by one, also if equal;
other columns are not read. Without training documents every token has the probability its code and one unknown leave.
Tokens and texts are compared by hashes of 56 bits or more, contexts by 48.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import query, table
from .textscan import Texts, mix, mix_one, signed, slices
from .work import Work, result

BITS = 8
TABLES = 4
SENT_TOKENS = 1 << 22
SENT_CONTEXTS = 1 << 15
GATES = BITS * 4
STEPS = 25
RATE = 0.02
MINI_BATCH = 8192
# Training tokens to a bucket of contexts; a hot context may bring more, in 2^16 entries at most.
BUCKET_TOKENS = 1 << 20
# Tokens of a pack for each bucket, and of a pack in all at most.
PACKED, PACK_MOST = 4096, 1 << 21
# Contexts whose counts are unpacked together.
UNPACKED = 4096
# Distinct tokens, or entries after a token, a task gathers before it passes their counts on.
GATHERED = 1 << 20
# Parts of the counts: tokens, entries after a token, codes after two codes.
TOKEN, AFTER, PAGE = -1, 0, 1
# Weights are summed as whole numbers of this fraction.
UNIT = 1 << 16

_CODE = np.uint64((1 << BITS) - 1)
END = (mix_one(0xE0D) & ~int(_CODE)) | 0xA5
START = 0x57A7 << BITS


def _context(token: np.ndarray) -> np.ndarray:
    """40 bits of a token's hash and its code."""
    return (mix(token + np.uint64(2)) >> np.uint64(24)) << np.uint64(8) | token & _CODE


class Tokens:
    """The tokens of a batch in a row: 56 bits of the word's hash and its code; contexts of each."""

    def __init__(self, texts: Texts):
        data, a, z = texts.data, texts.start, texts.end - 1
        head = data[a].astype(np.uint64) << np.uint64(8) | data[np.minimum(a + 1, z)]
        tail = data[np.maximum(z - 1, a)].astype(np.uint64) << np.uint64(8) | data[z]
        code = (mix(head) >> np.uint64(60)) << np.uint64(4) | mix(tail + np.uint64(1 << 20)) >> np.uint64(60)
        words = (texts.words() & ~_CODE) | code
        n_words, docs = len(words), texts.n
        self.ends = texts.first[1:] + np.arange(docs)
        self.id = np.empty(n_words + docs, np.uint64)
        self.id[np.arange(n_words) + texts.text_of_word()] = words
        self.id[self.ends] = END
        self.begins = np.concatenate(([0], self.ends[:-1] + 1)) if docs else np.zeros(0, np.int64)
        self.code = (self.id & _CODE).astype(np.int64)
        one = np.concatenate((np.array([START], np.uint64), self.id))[:len(self.id)]
        one[self.begins] = START
        two = np.concatenate((np.array([START], np.uint64), one))[:len(self.id)]
        two[self.begins] = START
        self.before, self.two = (one & _CODE).astype(np.int64), (two & _CODE).astype(np.int64)
        # The context, then the entry: the code before it and the token's own.
        self.key = _context(one) << np.uint64(16) | (two & _CODE) << np.uint64(8) | self.id & _CODE

    def page(self) -> np.ndarray:
        return (self.before << 16 | self.two << 8 | self.code).astype(np.uint64)


def _summed(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the sum of each."""
    value, which = np.unique(key, return_inverse=True)
    return value, np.bincount(which, weights=times, minlength=len(value)).astype(np.int64)


def _lists(begin: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(values, pa.int32()))


def _listed(part: int, key: np.ndarray, times: np.ndarray, low: int) -> pa.RecordBatch:
    """Rows `(part, key, c, codes, times)`, one for each context of sorted keys, whose last `low` bits are the entry."""
    context = (key >> np.uint64(low)).astype(np.int64)
    begin = np.flatnonzero(np.diff(context, prepend=-1))
    ends = np.append(begin, len(key))
    c = np.add.reduceat(times, begin) if len(begin) else np.zeros(0, np.int64)
    codes = (key & np.uint64((1 << low) - 1)).astype(np.int64)
    return pa.record_batch([pa.array(np.full(len(begin), part, np.int32)), pa.array(context[begin]), pa.array(c), _lists(ends, codes), _lists(ends, times)],
                           ["part", "key", "c", "codes", "times"])


class Gathered:
    """Counts of keys, merged whenever many have come in."""

    def __init__(self):
        self.held, self.size = [], 0

    def add(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """The counts so far, if there are too many to be kept."""
        self.held.append(np.unique(key, return_counts=True))
        self.size += len(self.held[-1][0])
        if self.size > 2 * GATHERED:
            found = self.all()
            if len(found[0]) > GATHERED:
                return found
            self.held, self.size = [found], len(found[0])
        return None

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        held, self.held, self.size = self.held, [], 0
        if not held:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return _summed(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows `(part, key, c, codes, times)`: counts of tokens, and for each context those of the entries that follow."""
    def rows(part, found):
        if part != TOKEN:
            return _listed(part, *found, low=16 if part == AFTER else 8)
        n = len(found[0])
        nothing = pa.nulls(n, pa.list_(pa.int32()))
        return pa.record_batch([pa.array(np.full(n, TOKEN, np.int32)), pa.array(signed(found[0])), pa.array(found[1]), nothing, nothing],
                               ["part", "key", "c", "codes", "times"])

    gathered = {part: Gathered() for part in (TOKEN, AFTER, PAGE)}
    for batch in slices(batches):
        found = Tokens(Texts(batch.column("text")))
        for part, key in ((TOKEN, found.id), (AFTER, found.key), (PAGE, found.page())):
            if (full := gathered[part].add(key)) is not None:
                yield rows(part, full)
    for part, held in gathered.items():
        yield rows(part, held.all())


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """`(key, begin, codes, times)` of some contexts at a time, each once, from rows that come sorted by key."""
    held: list[np.ndarray] | None = None

    def merged(key, length, codes, times):
        of = np.cumsum(np.diff(key, prepend=key[:1]) != 0)
        both, times = _summed(np.repeat(of, length) << 16 | codes, times)
        group = both >> 16
        first = np.flatnonzero(np.diff(of, prepend=-1))
        return key[first], np.searchsorted(group, np.arange(len(first) + 1)), both & 0xFFFF, times

    for batch in batches:
        codes, times = batch.column("codes"), batch.column("times")
        now = [batch.column("key").to_numpy(), np.diff(codes.offsets.to_numpy()), codes.flatten().to_numpy(), times.flatten().to_numpy()]
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now)]
        key, length, codes, times = now
        if not len(key):
            continue
        stop = int(np.searchsorted(key, key[-1]))
        cut = int(length[:stop].sum())
        if stop:
            yield merged(key[:stop], length[:stop], codes[:cut], times[:cut])
        held = [key[stop:], length[stop:], codes[cut:], times[cut:]]
    if held is not None:
        yield merged(*held)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows `(key, codes, times)`, one for each context."""
    for key, begin, codes, times in _whole(batches):
        yield pa.record_batch([pa.array(key), _lists(begin, codes), _lists(begin, times)], ["key", "codes", "times"])


_NODES = ((1 << BITS | np.arange(1 << BITS))[:, None] >> np.arange(BITS, -1, -1)).astype(np.int64)


def _heaps(begin: np.ndarray, codes: np.ndarray, times: np.ndarray) -> np.ndarray:
    """A heap for each list of codes: node 1 has all its tokens, node `256 | code` those of a code."""
    heaps = np.zeros((len(begin) - 1, 2 << BITS), np.float32)
    heaps[np.repeat(np.arange(len(begin) - 1), np.diff(begin)), codes.astype(np.int64) | 1 << BITS] = times
    return _filled(heaps)


def _filled(heaps: np.ndarray) -> np.ndarray:
    """Heaps whose codes are set, with their inner nodes."""
    for depth in range(BITS - 1, -1, -1):
        below = heaps[:, 2 << depth:4 << depth]
        # Two strided halves: a sum over an axis of two takes several times as long.
        np.add(below[:, ::2], below[:, 1::2], out=heaps[:, 1 << depth:2 << depth])
    return heaps


def _without_own(heaps: np.ndarray) -> np.ndarray:
    """At each node the stretched probability of the way to it, with one token that took it left out."""
    value = np.zeros(heaps.shape, np.float32)
    toward = heaps[:, 2:]
    other = np.repeat(heaps[:, 1:1 << BITS], 2, axis=1) - toward
    value[:, 2:] = np.log((np.maximum(toward - 1, 0) + 0.4) / (other + 0.4))
    return value


def _stretched(heaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At each inner node the stretched probability of a set bit, and the class of its count."""
    left, right = heaps[:, 2::2], heaps[:, 3::2]
    value = np.zeros((len(heaps), 1 << BITS), np.float32)
    value[:, 1:] = np.log((right + np.float32(0.4)) / (left + np.float32(0.4)))
    seen = np.zeros((len(heaps), 1 << BITS), np.uint8)
    n = left + right
    seen[:, 1:] = (n > 0).astype(np.uint8) + (n > 16) + (n > 256)
    return value, seen


class Contexts:
    """Lists of counted codes by context, unpacked in a task when it needs them."""

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks()
        rows = rows.take(pa.array(np.argsort(rows["key"].to_numpy())))
        self.key = rows["key"].to_numpy()
        codes, times = (pa.concat_arrays(rows[c].chunks) if rows.num_rows else pa.array([], pa.list_(pa.int32())) for c in ("codes", "times"))
        self.begin = np.append(0, np.cumsum(np.diff(codes.offsets.to_numpy()))).astype(np.int64)
        self.codes, self.times = (codes.flatten().to_numpy() & 0xFF).astype(np.uint8), times.flatten().to_numpy().astype(np.float32)

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("key", "begin", "codes", "times")}

    def some(self, first: int, last: int) -> np.ndarray:
        a, b = self.begin[first], self.begin[last]
        return _heaps(self.begin[first:last + 1] - a, self.codes[a:b], self.times[a:b])

    @functools.cached_property
    def stretched(self) -> tuple[np.ndarray, np.ndarray]:
        """For each context, and in the end one that was never seen."""
        value = np.zeros((len(self.key) + 1, 1 << BITS), np.float32)
        seen = np.zeros((len(self.key) + 1, 1 << BITS), np.uint8)
        for at in range(0, len(self.key), UNPACKED):
            to = min(at + UNPACKED, len(self.key))
            value[at:to], seen[at:to] = _stretched(self.some(at, to))
        return value, seen

    def row(self, key: np.ndarray) -> np.ndarray:
        """The place of each context, the last for one that is not here."""
        at = np.searchsorted(self.key, key)
        at[np.append(self.key, -1)[at] != key] = len(self.key)
        return at


class Pages(Contexts):
    """Contexts of codes before. Those of fewer codes sum those of more."""

    @functools.cached_property
    def place(self) -> np.ndarray:
        return self.row(np.arange(1 << 2 * BITS))

    @functools.cached_property
    def paged(self) -> np.ndarray:
        """For scoring: the stretched table of two codes before, which opens no gate."""
        value = np.zeros((len(self.key) + 1, 1 << BITS), np.float32)
        for at in range(0, len(self.key), UNPACKED):
            to = min(at + UNPACKED, len(self.key))
            value[at:to] = _stretched(self.some(at, to))[0]
        return value

    @functools.cached_property
    def without_own(self) -> list[np.ndarray]:
        """For learning: the tables of no, one and two codes before, less one token's own count."""
        out = np.zeros((len(self.key) + 1, 2 << BITS), np.float32)
        for at in range(0, len(self.key), UNPACKED):
            to = min(at + UNPACKED, len(self.key))
            out[at:to] = _without_own(self.some(at, to))
        return [_without_own(self.before.sum(0, keepdims=True)), _without_own(self.before), out]

    @functools.cached_property
    def before(self) -> np.ndarray:
        out = np.zeros((1 << BITS, 2 << BITS), np.float64)
        for at in range(0, len(self.key), UNPACKED):
            to = min(at + UNPACKED, len(self.key))
            np.add.at(out, self.key[at:to] >> BITS, self.some(at, to).astype(np.float64))
        return out

    @functools.cached_property
    def inputs(self) -> np.ndarray:
        """(code before, code) to the inputs of the tables of no and one code before."""
        every = _stretched(self.before.sum(0, keepdims=True))[0][0][_NODES[:, :-1]]
        one = _stretched(self.before)[0][:, _NODES[:, :-1]]
        return np.stack([np.broadcast_to(every, one.shape), one], 2).reshape(-1, 2, BITS)


def _squash(x):
    return 1 / (1 + np.exp(-x))


class Mixer:
    """Predictions of all bits of some tokens, from the counts on the paths to their codes."""

    def __init__(self, weights: np.ndarray | None = None):
        self.weights = np.full((GATES, TABLES), 1 / TABLES + 0.1, np.float32) if weights is None else weights

    def inputs(self, stretched: list[np.ndarray], path: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Stretched predictions (tables, tokens x bits), gates and bits. `stretched` is toward the code, in the tables but that of the
        token before, whose counts on the path come with the token's own."""
        bit = (code[:, None] >> np.arange(BITS - 1, -1, -1)) & 1
        sign = (2 * bit - 1).astype(np.float32)
        toward = path[:, 1:] - 1
        other = path[:, :-1] - path[:, 1:]
        n = toward + other
        gate = np.arange(BITS) * 4 + (n > 0).astype(np.int64) + (n > 16) + (n > 256)
        after = np.log((toward + np.float32(0.4)) / (other + np.float32(0.4)))
        x = np.empty((TABLES, code.size * BITS), np.float32)
        for t, value in enumerate((stretched[0], stretched[1], after, stretched[2])):
            np.multiply(sign, value, out=x[t].reshape(sign.shape))
        return x, gate.ravel(), bit.ravel()

    def mixed(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return np.clip(np.einsum("tn,nt->n", x, self.weights[gate]), -14, 14)

    def learn(self, x: np.ndarray, gate: np.ndarray, bit: np.ndarray, times: np.ndarray) -> np.ndarray:
        """One online step for a mini-batch; the mixed predictions before it. Gates of different bits do not touch."""
        before = self.mixed(x, gate)
        error = (bit - _squash(before)) * times
        n = np.maximum(np.bincount(gate, weights=times, minlength=GATES), 1)
        for t in range(TABLES):
            self.weights[:, t] += RATE * np.bincount(gate, weights=error * x[t], minlength=GATES) / n
        return before


class Learner:
    """The mixer of one bucket after the other, over entries of whole contexts in the order of their keys."""

    def __init__(self, pages: Pages, bits: int):
        self.pages, self.bits, self.bucket = pages, bits, None

    def add(self, key: np.ndarray, begin: np.ndarray, codes: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Learn from some more contexts; what the buckets have come to that end here."""
        of = key >> (48 - self.bits)
        edges = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(key)] if len(key) else [0]
        for a, b in zip(edges[:-1], edges[1:]):
            if of[a] != self.bucket:
                yield from self.end()
                self.bucket, self.mixer = of[a], Mixer()
                self.used, self.seen = np.zeros(GATES), np.zeros((BITS * STEPS, 2))
                self.held = [np.zeros(0, np.int64)] * 4
            now = [key[a:b], np.diff(begin[a:b + 1]), codes[begin[a]:begin[b]], times[begin[a]:begin[b]]]
            self.held = [np.concatenate(x) for x in zip(self.held, now)]
            self.run(MINI_BATCH)

    def run(self, least: int) -> None:
        """Steps of the held contexts, each of the fewest with `least` entries."""
        key, length, codes, times = self.held
        ends, at, done = np.cumsum(length), 0, 0
        while at < len(key):
            to = int(np.searchsorted(ends, done + least)) + 1
            if to > len(key):
                break
            self.step(key[at:to], length[at:to], codes[done:ends[to - 1]], times[done:ends[to - 1]])
            at, done = to, int(ends[to - 1])
        self.held = [key[at:], length[at:], codes[done:], times[done:]]

    def step(self, key, length, codes, times) -> None:
        row, code = np.repeat(np.arange(len(key)), length), codes & 0xFF
        after = np.zeros((len(key), 2 << BITS), np.float32)
        after[:, 1 << BITS:] = np.bincount(row << BITS | code, weights=times, minlength=len(key) << BITS).reshape(len(key), 1 << BITS)
        after = _filled(after).reshape(-1)
        before, nodes = (key & 0xFF)[row], _NODES[code]
        pages, steps = self.pages, nodes[:, 1:]
        every, one, two = (x.reshape(-1) for x in pages.without_own)
        place = pages.place[before << 8 | codes >> 8]
        stretched = [every[steps], one[(before << BITS + 1)[:, None] | steps], two[(place << BITS + 1)[:, None] | steps]]
        x, gate, bit = self.mixer.inputs(stretched, after[(row << BITS + 1)[:, None] | nodes], code)
        times = np.repeat(times, BITS)
        at = _step(self.mixer.learn(x, gate, bit, times))
        self.used += np.bincount(gate, weights=times, minlength=GATES)
        self.seen[:, 1] += np.bincount(at, weights=bit * times, minlength=len(self.seen))
        self.seen[:, 0] += np.bincount(at, weights=(1 - bit) * times, minlength=len(self.seen))

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.bucket is None:
            return
        self.run(1)
        self.bucket = None
        table = np.concatenate((np.repeat(np.arange(TABLES), GATES), np.full(len(self.seen), TABLES)))
        slot = np.concatenate((np.tile(np.arange(GATES), TABLES), np.arange(len(self.seen))))
        value = np.concatenate(((self.mixer.weights * self.used[:, None] * UNIT).T.ravel(), self.seen[:, 1]))
        weight = np.concatenate((np.tile(self.used, TABLES), self.seen.sum(1)))
        nulls = [pa.nulls(len(slot), x) for x in (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))]
        yield pa.record_batch([*nulls, *[pa.array(np.rint(x).astype(np.int64)) for x in (table, slot, value, weight)]], names=_LEARNED)


_LEARNED = ["key", "c", "codes", "times", "part", "slot", "value", "weight"]


def _learn(pages, bits: int):
    """Rows `(key, c, codes, times)` of contexts, from entries sorted by key, and `(part, slot, value, weight)` of what is learned."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = Learner(pages.value, bits)
        for key, begin, codes, times in _whole(batches):
            row = np.repeat(np.arange(len(key)), np.diff(begin))
            both, n = _summed(row << BITS | codes & 0xFF, times)
            ends = np.searchsorted(both >> BITS, np.arange(len(key) + 1))
            c = np.bincount(both >> BITS, weights=n, minlength=len(key)).astype(np.int64)
            nulls = [pa.nulls(len(key), pa.int64())] * 4
            yield pa.record_batch([pa.array(key), pa.array(c), _lists(ends, both & 0xFF), _lists(ends, n), *nulls], names=_LEARNED)
            yield from learner.add(key, begin, codes, times)
        yield from learner.end()

    return run


def _step(mixed: np.ndarray) -> np.ndarray:
    depth = np.arange(BITS) if mixed.ndim == 2 else np.arange(mixed.size) % BITS
    return depth * STEPS + np.clip(np.rint(mixed * 2) + STEPS // 2, 0, STEPS - 1).astype(np.int64)


def _looked_up(after: tuple[np.ndarray, np.ndarray], row: np.ndarray):
    """What `_stretched` tables of contexts tell on paths; `row` is each path's context."""
    value, seen = (x.reshape(-1) for x in after)

    def found(some: slice, nodes: np.ndarray, bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = (row[some] << BITS)[:, None] | nodes[:, :-1]
        return value.take(place), seen.take(place)

    return found


def _counted(heaps: np.ndarray, row: np.ndarray):
    """The same from heaps of contexts, for few paths of many contexts."""
    counts = heaps.reshape(-1)

    def found(some: slice, nodes: np.ndarray, bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        path = counts.take((row[some] << BITS + 1)[:, None] | nodes)
        n, toward = path[:, :-1], path[:, 1:]
        value = np.log((toward + np.float32(0.4)) / (n - toward + np.float32(0.4)))
        return np.where(bit == 1, value, -value), (n > 0).astype(np.uint8) + (n > 16) + (n > 256)

    return found


class Scorer:
    """Probabilities of codes by the learned weights and map."""

    def __init__(self, weights: np.ndarray, refined: np.ndarray, pages: Pages):
        self.refined, self.after, self.two = refined, np.ascontiguousarray(weights[:, 2]), np.ascontiguousarray(weights[:, 3])
        # The tables of no and one code before have few inputs, which are weighed once for each class of the gate.
        every, one = weights[:, 0].reshape(BITS, -1), weights[:, 1].reshape(BITS, -1)
        self.weighed = (every * pages.inputs[:, 0, :, None] + one * pages.inputs[:, 1, :, None]).reshape(-1)
        self.paged, self.place = pages.paged.reshape(-1), pages.place << BITS

    def logs(self, entry: np.ndarray, after) -> np.ndarray:
        """The log of each code's probability. `entry` has three codes, its own the last; `after` tells of the token before's table."""
        out = np.empty(len(entry))
        for at in range(0, len(entry), MINI_BATCH):
            some = slice(at, at + MINI_BATCH)
            e = entry[some]
            code = e & 0xFF
            nodes, bit = _NODES[code], (code[:, None] >> np.arange(BITS - 1, -1, -1)) & 1
            value, seen = after(some, nodes, bit)
            gate = np.arange(BITS) * 4 + seen
            mixed = self.weighed.take((((e >> 16) << BITS | code) * GATES)[:, None] + gate)
            mixed += self.after.take(gate) * value
            mixed += self.two.take(gate) * self.paged.take(self.place[e >> 8][:, None] | nodes[:, :-1])
            np.clip(mixed, -14, 14, out=mixed)
            p = (_squash(mixed) + self.refined.take(_step(mixed))) / 2
            p = np.where(bit == 1, p, 1 - p)
            # Halves of the row are multiplied, for a product over a short axis takes several times as long.
            while p.shape[1] > 1:
                p = p[:, ::2] * p[:, 1::2]
            out[some] = np.log10(p[:, 0])
        return out


_FOUND = {
    "rid": "long", "id": "string", "held_out": "boolean", "n_tokens": "long", "n_bytes": "long", "known": "long", "logs": "double", "mixed": "double",
    "token": "long", "count": "long", "bucket": "long", "keys": "array<long>", "docs": "array<int>", "times": "array<int>"}
_ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}


def _found(n: int, **columns) -> pa.RecordBatch:
    """Rows of `_FOUND`; columns that are not given are null."""
    schema = pa.schema([(name, _ARROW[kind]) for name, kind in _FOUND.items()])
    return pa.record_batch([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


class Packs:
    """Tokens on their way to their contexts' buckets."""

    def __init__(self, base: int, bits: int):
        self.base, self.bits, self.keys, self.docs, self.size = base, bits, [], [], 0

    def add(self, keys: np.ndarray, docs: np.ndarray) -> None:
        self.keys.append(keys)
        self.docs.append(docs)
        self.size += len(keys)

    def full(self) -> bool:
        return self.size >= min(PACKED << self.bits, PACK_MOST)

    def rows(self) -> pa.RecordBatch:
        """A row for each bucket: distinct (key, document) and their number; documents count from `rid`."""
        keys, docs = np.concatenate(self.keys), np.concatenate(self.docs)
        order = np.argsort(keys, kind="stable")
        keys, docs = keys[order], docs[order]
        first = np.ones(len(keys), bool)
        first[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
        at = np.flatnonzero(first)
        times = np.diff(np.append(at, len(keys)))
        keys, docs = keys[at], docs[at]
        of = _bucket(keys, self.bits)
        begin = np.flatnonzero(np.diff(of, prepend=-1))
        ends = np.append(begin, len(of))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(signed(keys)))
        return _found(len(begin), rid=pa.array(np.full(len(begin), self.base)), bucket=pa.array(of[begin]), keys=lists,
                      docs=_lists(ends, docs), times=_lists(ends, times))


def _bucket(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys >> np.uint64(1)) >> np.uint64(63 - bits)).astype(np.int64)


def _score(contexts, pages, model, bits: int):
    """A row per document, rows `(rid, token, count)` for tokens that were not sent, and packs for contexts that were not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, refined, sent, sent_logs, code_logs = model.value
        scorer = Scorer(weights, refined, pages.value)
        rid = TaskContext.get().partitionId() << 40
        packs = Packs(rid, bits)
        for batch in slices(batches):
            texts = Texts(batch.column("text"))
            found = Tokens(texts)
            of = np.repeat(np.arange(texts.n), np.diff(np.append(found.begins, len(found.id))))
            # A token before is looked up once.
            value, which = np.unique(found.id, return_inverse=True)
            rows = contexts.value.row(_context(np.append(value, np.uint64(START))).astype(np.int64))
            row = np.append(rows[-1:], rows[which])[:len(which)]
            row[found.begins] = rows[-1]
            sent_here = row < len(contexts.value.key)
            here, there = np.flatnonzero(sent_here), np.flatnonzero(~sent_here)
            logs = np.zeros(len(found.id))
            entry = (found.key[here] & np.uint64(0xFFFFFF)).astype(np.int64)
            logs[here] = scorer.logs(entry, _looked_up(contexts.value.stretched, row[here]))
            packs.add(found.key[there], of[there] + (rid - packs.base))
            logs -= code_logs[found.code]
            at = np.minimum(np.searchsorted(sent, value), max(len(sent) - 1, 0))
            is_sent = sent[at] == value if len(sent) else np.zeros(len(value), bool)
            own = is_sent[which]
            count_logs = np.where(own, sent_logs[at][which] if len(sent) else 0.0, 0.0)

            def sums(x):
                return np.bincount(of, weights=x, minlength=texts.n)

            rids = rid + np.arange(texts.n)
            rid += texts.n
            yield _found(
                texts.n, rid=pa.array(rids), id=batch.column("id"), held_out=batch.column("held_out"), n_tokens=pa.array(np.bincount(of, minlength=texts.n)),
                n_bytes=pa.array(np.diff(texts.offset)), known=pa.array(sums(own).astype(np.int64)), logs=pa.array(sums(count_logs)), mixed=pa.array(sums(logs)))
            rest = ~own
            if rest.any():
                pair, times = _pairs(of[rest], which[rest])
                yield _found(len(times), rid=pa.array(rids[pair[0]]), token=pa.array(signed(value[pair[1]])), count=pa.array(times))
            if packs.full():
                yield packs.rows()
                packs = Packs(rid, bits)
        if packs.size:
            yield packs.rows()

    return run


def _score_bucket(pages, model):
    """Rows `(rid, bucket, docs, logs)`: what the tokens of a bucket add to their documents, a row for each pack."""
    def flat(table: pa.Table, name: str) -> np.ndarray:
        column = table.column(name)
        return pa.concat_arrays(column.chunks).flatten().to_numpy() if column.num_chunks else np.zeros(0, np.int64)

    def run(packs: pa.Table, contexts: pa.Table) -> pa.Table:
        scorer = Scorer(*model.value[:2], pages.value)
        packs = packs.sort_by("rid")
        keys, which = np.unique(flat(packs, "keys").view(np.uint64), return_inverse=True)
        known = Contexts(contexts)
        context, logs = (keys >> np.uint64(16)).astype(np.int64), np.zeros(len(keys))
        entry = (keys & np.uint64(0xFFFFFF)).astype(np.int64)
        starts = list(range(0, len(known.key), UNPACKED)) or [0]
        cuts = [0, *np.searchsorted(context, known.key[starts[1:]]).tolist(), len(keys)]
        for at, a, b in zip(starts, cuts[:-1], cuts[1:]):
            to = min(at + UNPACKED, len(known.key))
            heaps = np.concatenate([known.some(at, to), np.zeros((1, 2 << BITS), np.float32)])
            row = known.row(context[a:b]) - at
            row[(row < 0) | (row > to - at)] = to - at
            logs[a:b] = scorer.logs(entry[a:b], _counted(heaps, row))
        pack = np.repeat(np.arange(packs.num_rows), pc.list_value_length(packs.column("keys")).to_numpy())
        place, of = np.unique(pack << 32 | flat(packs, "docs"), return_inverse=True)
        sums = np.bincount(of, weights=logs[which] * flat(packs, "times"), minlength=len(place))
        ends = np.searchsorted(place >> 32, np.arange(packs.num_rows + 1))
        return pa.table({
            "rid": packs.column("rid"), "bucket": packs.column("bucket"), "docs": _lists(ends, place & 0xFFFFFFFF),
            "logs": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(sums))})

    return run


def _brought_back(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """Rows `(rid, there)`: the sums of all buckets for the documents of a pack."""
    rows = rows.sort_by("bucket")
    docs, logs = (pa.concat_arrays(rows.column(c).chunks).flatten().to_numpy() for c in ("docs", "logs"))
    there = np.bincount(docs, weights=logs)
    some = np.flatnonzero(np.bincount(docs))
    return pa.table({"rid": pa.array(key[0].as_py() + some), "there": pa.array(there[some])})


def _pairs(a: np.ndarray, b: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Distinct pairs of small numbers and how often each occurs."""
    both, times = np.unique(a.astype(np.int64) << 32 | b, return_counts=True)
    return (both >> 32, both & 0xFFFFFFFF), times


def scores(docs: DataFrame, held_out, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document `(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte)`.

    `held_out` is a Column that is true for documents that are not learned from.
    """
    spark = docs.sparkSession
    id_sql = dict(docs.select(id_col).dtypes)[id_col]
    rows = docs.select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    train = rows.where("not held_out").select("text")
    with Work(spark, "language-model") as work:
        lists = "key long, codes array<int>, times array<int>"
        gathered = work.keep(train.mapInArrow(_counts, "part int, key long, c long, codes array<int>, times array<int>"), "gathered", "zstd")
        words = work.keep(gathered.where(F.col("part") == TOKEN).groupBy(F.col("key").alias("token")).agg(F.sum("c").alias("c")), "words")
        per_code = words.groupBy(F.col("token").bitwiseAND(F.lit(int(_CODE))).alias("code")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
        n = sum(r.n for r in per_code)
        v = sum(r.v for r in per_code)
        bits = max(n // BUCKET_TOKENS, 1).bit_length() - 1
        code_logs = np.full(1 << BITS, np.log10(0.5))
        for r in per_code:
            code_logs[r.code] = np.log10(r.n + 0.5 * (r.v + 1))

        by_page = gathered.where(F.col("part") == PAGE).select("key", "codes", "times").repartition("key").sortWithinPartitions("key")
        found = Pages(by_page.mapInArrow(_merged, lists).toArrow())
        # Two copies: what a worker unpacks to learn goes with the first, before it unpacks the second to score.
        learning, pages = spark.sparkContext.broadcast(found), spark.sparkContext.broadcast(found)
        bucket = F.shiftright("key", 48 - bits)
        entries = gathered.where(F.col("part") == AFTER).select("key", "codes", "times", bucket.alias("bucket"))
        learned = work.keep(
            entries.repartition("bucket").sortWithinPartitions("key").drop("bucket")
            .mapInArrow(_learn(learning, bits), "key long, c long, codes array<int>, times array<int>, part long, slot long, value long, weight long"), "contexts", "zstd")
        work.drop(gathered)
        learning.destroy()
        weights = Mixer().weights
        refined = _squash((np.tile(np.arange(STEPS), BITS) - STEPS // 2) / 2)
        for r in learned.where("key is null").groupBy("part", "slot").agg(F.sum("value").alias("value"), F.sum("weight").alias("weight")).collect():
            if r.part < TABLES and r.weight:
                weights[r.slot, r.part] = r.value / UNIT / r.weight
            elif r.part == TABLES:
                refined[r.slot] = (r.value + 16 * refined[r.slot]) / (r.weight + 16)

        after = learned.where("key is not null").select("key", "c", "codes", "times")
        often = F.col("c") * SENT_CONTEXTS >= n
        contexts = spark.sparkContext.broadcast(Contexts(after.where(often).select("key", "codes", "times").toArrow()))
        sent = words.where(F.col("c") * SENT_TOKENS >= n).toArrow()
        token, c = sent["token"].to_numpy().view(np.uint64), sent["c"].to_numpy()
        order = np.argsort(token)
        model = spark.sparkContext.broadcast((weights, refined, token[order], np.log10(c[order] + 0.5), code_logs))
        found = work.keep(rows.mapInArrow(_score(contexts, pages, model, bits), ", ".join(f"{a} {b}" for a, b in _FOUND.items())), "found", "zstd")
        packs = found.where("bucket is not null").select("rid", "bucket", "keys", "docs", "times").groupBy("bucket")
        others = after.where(~often).select(bucket.alias("bucket"), "key", "codes", "times").groupBy("bucket")
        there = work.keep(
            packs.cogroup(others).applyInArrow(_score_bucket(pages, model), "rid long, bucket long, docs array<int>, logs array<double>"), "packs")
        work.drop(learned)
        there = there.groupBy("rid").applyInArrow(_brought_back, "rid long, there double")
        rest = (
            found.where("token is not null").join(words, "token", "left").groupBy("rid").agg(
                F.sum(F.col("count") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))).alias("rest_logs"),
                F.sum(F.when(F.col("c") > 0, F.col("count")).otherwise(0)).alias("rest_known")))
        logs = F.col("logs") + F.coalesce("rest_logs", F.lit(0.0))
        score = F.col("mixed") + F.coalesce("there", F.lit(0.0)) + logs
        out = result(found.where("n_tokens is not null").join(rest, "rid", "left").join(there, "rid", "left").select(
            F.col("id").cast(id_sql).alias(id_col), "held_out", "n_tokens", (F.col("known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
            F.lit(n).cast("long").alias("train_tokens"),
            (logs - F.col("n_tokens") * F.lit(float(np.log10(n + 0.5 * (v + 1))))).alias("base_score"), score.alias("score"),
            F.when(F.col("n_bytes") > 0, -score / F.lit(float(np.log10(2))) / F.col("n_bytes")).alias("bits_per_byte")))
        for shared in (pages, contexts, model):
            shared.destroy()
        return out


@query("op6_language_model")
def op6(spark, sf_dir):
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1
    return scores(table(spark, sf_dir, "documents"), held_out)
