"""Words of whole texts as arrays: Arrow batches in, word places and 64-bit hashes out.

A word is a maximal run of bytes other than `\\x20` and `\\x09`-`\\x0D`, or than those of a table of the caller's. Everything is done on the UTF-8
bytes of many texts at once; a null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are scanned together up to this many bytes; a longer text is scanned alone.
CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_PRIME = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_PRIME, -1, 1 << 64)
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def mix_one(x: int) -> int:
    return int(mix(np.array([x & 0xFFFFFFFFFFFFFFFF], np.uint64))[0])


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of about `most` bytes of text or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, begin = np.cumsum(size, dtype=np.int64), 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


class Texts:
    """The bytes of texts and their words: `start` and `end` of each word, `first[d]:first[d + 1]` those of text d."""

    def __init__(self, texts: pa.Array, lower: bool = True, space: np.ndarray = SPACE):
        texts = pc.fill_null(texts, "")
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
        _, offsets, data = texts.buffers()
        kind = np.int64 if wide else np.int32
        offset = np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8)[offset[0]:offset[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
        self.raw = raw
        self.data = LOWER[raw] if lower else raw
        self.offset = offset - offset[0]
        self.n = len(texts)
        word = ~space[raw]
        edge = self.offset[:-1][self.offset[:-1] < len(raw)]
        before = np.empty_like(word)
        before[:1] = False
        before[1:] = word[:-1]
        before[edge] = False
        self.start = np.flatnonzero(word & ~before)
        after = np.empty_like(word)
        after[-1:] = False
        after[:-1] = word[1:]
        after[edge[edge > 0] - 1] = False
        self.end = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.start, self.offset)
        self.in_word = word

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of the bytes from each start to before each end."""
        n = len(self.data)
        if not hasattr(self, "_sums"):
            self._sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTE[self.data] * _power(_PRIME, n), out=self._sums[1:])
        value = (self._sums[end] - self._sums[start]) * _power(_INVERSE, n + 1)[start]
        return mix(value + (end - start).astype(np.uint64))

    def words(self) -> np.ndarray:
        """The hash of every word."""
        return self.ranges(self.start, self.end)

    def text_of_word(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(self.n), np.diff(self.first))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k values in a row, as if they were one text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += hashes[j:j + n] * np.uint64(pow(_PRIME, 3 * j + 1, 1 << 64))
    return mix(total)


def shingles(texts: Texts, k: int) -> list[np.ndarray]:
    """The sorted distinct k-word shingles of each text; with fewer words the whole sequence is one."""
    words = texts.words()
    every = windows(words, k)
    out = []
    for a, b in zip(texts.first[:-1].tolist(), texts.first[1:].tolist()):
        if b - a >= k:
            found = every[a:b - k + 1].copy()
            found.sort()
            keep = np.empty(len(found), bool)
            keep[0] = True
            np.not_equal(found[1:], found[:-1], out=keep[1:])
            out.append(found[keep])
        elif b > a:
            out.append(windows(words[a:b] + np.uint64(b - a), b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark's signed longs."""
    return np.ascontiguousarray(x, np.uint64).view(np.int64)
