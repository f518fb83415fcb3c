"""Vectorised word handling on Arrow text columns: byte tables, word bounds, word hashes and shingle hashes.

A word is a maximal run of characters other than space and U+0009 to U+000D.  These are single bytes in UTF-8
and never part of a longer character, so all work happens on bytes.  Words are hashed by a polynomial over
random byte values modulo 2**64 and a finishing mix; 64-bit hashes stand for words and shingles.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
BLOCK = 1 << 16  # bytes that are hashed at a time
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
# other word rules: ASCII letters (and digits) and everything outside ASCII are word bytes, the rest parts words
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
NOT_ALNUM = NOT_LETTER.copy()
NOT_ALNUM[48:58] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_RNG = np.random.default_rng(20240607)
_BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = int(_RNG.integers(2**61, 2**62)) * 4 + 5
_INV = pow(_MUL, -1, 2**64)
_SLOT = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(-(-n >> 18) + 1 << 18, base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if len(have) <= CHUNK_BYTES * 2:
            _POWERS[base] = have
    return have


def _sums(data: np.ndarray) -> np.ndarray:
    """Sums of the values of all bytes before each place, each times the power of its place."""
    n = len(data)
    powers, out = _powers(_MUL, n), np.zeros(n + 1, np.uint64)
    for a in range(0, n, BLOCK):
        b = min(a + BLOCK, n)
        np.multiply(_BYTE_VALUE[data[a:b]], powers[a:b], out=out[a + 1: b + 1])
    return np.cumsum(out, out=out)


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError, TypeError):  # another C library
    _trim = None


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task yields; at its end the worker gives back the memory that it has freed.

    Spark keeps its workers for later tasks: while others, or the executor itself, need memory, an idle one should have little.
    """
    try:
        yield from batches
    finally:
        _POWERS.clear()
        pa.default_memory_pool().release_unused()
        if _trim is not None:
            _trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finishing mix of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and the offsets of each (nulls count as empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) over runs of whole texts of about ``limit`` bytes."""
    data, offsets = text_bytes(texts)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row]
        row = end


class Words:
    """Word bounds of a chunk: ``start``/``end`` byte offsets, ``doc`` (row in the chunk), ``count`` per row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE):
        self.data, self.offsets = data, offsets
        inside = ~breaks[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = offsets[1:-1]
        at = cuts[cuts < len(data)]
        first[at] = inside[at]
        at = cuts[cuts > 0] - 1
        last[at] = inside[at]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.count)

    def hashes(self, lower: bool = False, prefix: int | None = None) -> np.ndarray:
        """One 64-bit hash per word (or per its first ``prefix`` bytes)."""
        data = LOWER[self.data] if lower else self.data
        sums = _sums(data)
        end = self.end if prefix is None else np.minimum(self.end, self.start + prefix)
        return mix((sums[end] - sums[self.start]) * _powers(_INV, len(data) + 1)[self.start] + (end - self.start).astype(np.uint64))


class Ranges:
    """Hashes of any byte ranges of one buffer."""

    def __init__(self, data: np.ndarray):
        self.n = len(data)
        self.sums = _sums(data)
        self.back = _powers(_INV, self.n + 1)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        """The hash of the ``k`` bytes from each place on."""
        n = self.n - k + 1
        return mix((self.sums[k:] - self.sums[:n]) * self.back[:n] + np.uint64(k))


def windows(values: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``k`` values inside one document, and the position of its first value."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += mix(values[j: j + n] + _SLOT[j]) * _SLOT[63 - j]
    at = np.flatnonzero(doc[:n] == doc[k - 1: k - 1 + n])
    return mix(total[at]), at


def shingle_sets(words: Words, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes per text, sorted by (text, hash): the hashes and the bounds of each text.

    A text with fewer than ``k`` words has its whole word sequence as its one shingle; without words, none.
    """
    values, at = windows(hashes, words.doc, k)
    docs = words.doc[at]
    for size in range(1, k):
        short = np.flatnonzero(words.count == size)
        if len(short):
            total = np.zeros(len(short), np.uint64)
            for j in range(size):
                total += mix(hashes[words.bounds[short] + j] + _SLOT[j]) * _SLOT[63 - j]
            values = np.concatenate([values, mix(total + np.uint64(size))])
            docs = np.concatenate([docs, short])
    order = np.lexsort((values, docs))
    values, docs = values[order], docs[order]
    if len(values):
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (docs[1:] != docs[:-1])
        values, docs = values[new], docs[new]
    return values, np.searchsorted(docs, np.arange(len(words.count) + 1))


def text_hashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One 64-bit hash per whole text."""
    whole = Words.__new__(Words)
    whole.data, whole.start, whole.end = data, offsets[:-1], offsets[1:]
    return whole.hashes()
