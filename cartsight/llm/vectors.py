"""Words of many texts at once, as numpy arrays over the bytes of an Arrow batch.

A word is known by a 64-bit hash: random values of its bytes times powers of an
odd base, summed modulo 2**64.  Sums over words come from one running sum, so no
word becomes a Python object.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _MASK, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_held: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; those for a usual chunk are held."""
    if n <= CHUNK:
        if not _held:
            _held.extend((_powers(_BASE, CHUNK + 1), _powers(pow(_BASE, -1, 1 << 64), CHUNK + 1)))
        return _held[0][:n], _held[1][: n + 1]
    return _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n + 1)


def pieces(batch: pa.RecordBatch, column: str, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose texts hold ``limit`` bytes together; a longer text comes alone, whole."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if i > first and total + size > limit:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += int(size)
    if first < len(sizes):
        yield batch.slice(first)


class Texts:
    """The words of a text column: ``hash`` and ``doc`` of each word, ``first`` word of each text (one more entry at the end)."""

    def __init__(self, column: pa.Array, lower: bool = False):
        column = pa.compute.fill_null(column, "").cast(pa.large_binary())
        self.n = len(column)
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + self.n + 1]
        data = column.buffers()[2]
        self.bytes = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        inside = ~_SPACE[self.bytes]
        cut = np.zeros(len(self.bytes) + 1, bool)
        cut[self.offsets] = True
        before = np.ones(len(self.bytes), bool)
        before[1:] = ~inside[:-1]
        self.start = np.flatnonzero(inside & (before | cut[:-1]))
        after = np.ones(len(self.bytes), bool)
        after[:-1] = ~inside[1:]
        self.end = np.flatnonzero(inside & (after | cut[1:])) + 1
        up, down = powers(len(self.bytes))
        total = np.zeros(len(self.bytes) + 1, np.uint64)
        np.cumsum((_LOWER if lower else _BYTES)[self.bytes] * up, out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start])
        self.first = np.searchsorted(self.start, self.offsets)
        self.doc = np.repeat(np.arange(self.n), np.diff(self.first))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        """Sums over the words of each text."""
        return np.bincount(self.doc, weights=values, minlength=self.n)

    def byte_sums(self, flags: np.ndarray) -> np.ndarray:
        """Counts of the marked bytes of each text."""
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``size`` words inside one text, and the index of each run's first word."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = np.zeros(n, np.uint64)
        for k in range(size):
            total = total * np.uint64(_BASE) + self.hash[k : k + n]
        at = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        return mix(total[at]), at


def shingle_sets(texts: Texts, size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text: runs of ``size`` words; a shorter text is one shingle, none without words."""
    hashes, at = texts.runs(size)
    bounds = np.searchsorted(at, texts.first)
    out = []
    for i in range(texts.n):
        words = texts.first[i + 1] - texts.first[i]
        if words >= size:
            out.append(np.unique(hashes[bounds[i] : bounds[i + 1]]))
        elif words:
            total = 0
            for h in texts.hash[texts.first[i] : texts.first[i + 1]]:
                total = (total * _BASE + int(h)) & _MASK
            out.append(mix(np.array([total ^ int(words)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
