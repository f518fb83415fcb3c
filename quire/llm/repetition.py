"""Quality rules on repetition inside a text, found with suffix arrays over its words.

Texts without any repeated run of ``min_words`` words are done after one sort of window hashes.  For the others a
suffix array over all their words is built by prefix doubling (for all texts of a chunk at once); the longest
common prefix of neighbours in the array, read off the ranks of the doubling levels, gives for every position the
longest run of words that occurs again in the text.  The runs that are not the tail of a longer one are the
maximal repeated substrings; the union of their spans and the longest of them are limited.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quire.llm.words import Words, chunks, windows

# fixed values: the characters counted as symbols
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat",
          "n_repeats"]


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeated(values: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Whether each value occurs twice or more in its text."""
    order = np.lexsort((values, docs))
    v, d = values[order], docs[order]
    same = (v[1:] == v[:-1]) & (d[1:] == d[:-1])
    twice = np.zeros(len(v), bool)
    twice[1:] |= same
    twice[:-1] |= same
    out = np.zeros(len(v), bool)
    out[order] = twice
    return out


def _cover(start: np.ndarray, length: np.ndarray | int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a span."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) > 0


def duplicate_lines(words: Words) -> np.ndarray:
    """Per text, its lines with a word that equal an earlier line."""
    data, offsets = words.data, words.offsets
    if not len(data):
        return np.zeros(len(offsets) - 1, np.int64)
    starts = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(data == 10) + 1]))
    starts = starts[starts < len(data)]
    stops = np.append(starts[1:], len(data))
    stops = stops - (data[stops - 1] == 10)
    with_word = np.searchsorted(words.start, stops) > np.searchsorted(words.start, starts)
    starts, stops = starts[with_word], stops[with_word]
    line = Words.__new__(Words)
    line.data, line.start, line.end = data, starts, stops
    value, doc = line.hashes(), np.searchsorted(offsets, starts, "right") - 1
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    again = (value[1:] == value[:-1]) & (doc[1:] == doc[:-1])
    return np.bincount(doc[1:][again], minlength=len(offsets) - 1)


def longest_repeats(values: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For every position, the words of the longest run that starts there and occurs again in the same text.

    ``docs`` is ascending.  Ranks of all windows of 1, 2, 4, ... words are built until no window occurs twice.
    """
    n = len(values)
    _, rank = np.unique(np.stack([docs.astype(np.uint64), values], 1), axis=0, return_inverse=True)
    rank = rank.reshape(-1).astype(np.int64)
    end = np.searchsorted(docs, docs, "right")
    levels, width = [rank], 1
    where = np.arange(n)
    while True:
        inside = where + width < end
        after = np.where(inside, rank[np.minimum(where + width, n - 1)] + 1, 0)
        key = rank * (n + 1) + after
        _, rank = np.unique(key, return_inverse=True)
        rank = rank.reshape(-1)
        width *= 2
        if rank.max() == n - 1:
            break
        levels.append(rank)
    order = np.argsort(rank)  # the suffix array of all texts, text by text
    a, b = order[:-1], order[1:]
    common = np.zeros(n - 1, np.int64)
    for level in reversed(range(len(levels))):
        x, y = a + common, b + common
        ok = (x < end[a]) & (y < end[b]) & (docs[a] == docs[b])
        equal = np.zeros(n - 1, bool)
        equal[ok] = levels[level][x[ok]] == levels[level][y[ok]]
        common += equal * (1 << level)
    best = np.zeros(n, np.int64)
    best[a] = common
    np.maximum.at(best, b, common)
    return best


def measure(data: np.ndarray, offsets: np.ndarray, min_words: int) -> dict[str, np.ndarray]:
    w = Words(data, offsets)
    rows, n = len(offsets) - 1, len(w.start)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
    chars = np.concatenate([[0], np.cumsum(lead[w.end] - lead[w.start])])
    out = {"n_words": w.count, "word_chars": chars[w.bounds[1:]] - chars[w.bounds[:-1]],
           "n_symbols": _per_row(_SYMBOL[data], offsets), "n_dup_lines": duplicate_lines(w)}
    zero = np.zeros(rows, np.int64)
    out |= {k: zero for k in COUNTS[4:]}
    hashes = w.hashes()
    value, at = windows(hashes, w.doc, 5)
    twice = at[_repeated(value, w.doc[at])]
    if len(twice):
        out["n_repeat_words"] = _per_row(_cover(twice, 5, n), w.bounds)
    if min_words != 5:
        value, at = windows(hashes, w.doc, min_words)
        twice = at[_repeated(value, w.doc[at])]
    if len(twice):
        has = np.zeros(rows, bool)
        has[w.doc[twice]] = True
        part = np.flatnonzero(has[w.doc])  # all words of the texts with a repeated run
        docs = w.doc[part]
        best = longest_repeats(hashes[part], docs)
        tail = np.zeros(len(best), bool)
        tail[1:] = (best[1:] == best[:-1] - 1) & (docs[1:] == docs[:-1])
        maximal = np.flatnonzero((best >= min_words) & ~tail)
        bounds = np.searchsorted(docs, np.arange(rows + 1))
        out["covered_words"] = _per_row(_cover(maximal, best[maximal], len(best)), bounds)
        longest = zero.copy()
        np.maximum.at(longest, docs[maximal], best[maximal])
        out["longest_repeat"] = longest
        out["n_repeats"] = np.bincount(docs[maximal], minlength=rows)
    return out


def repetition_rules(docs: DataFrame, min_words: int = 5, max_covered: float = 0.20, max_longest: float = 0.06,
                     longest_floor: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, the counts of ``COUNTS``, base_failed and kept.

    base_failed: fewer than 10 words, or over 20 % of the words in 5-word windows that occur twice.  A text that
    passes is kept unless maximal repeats of at least ``min_words`` words cover over ``max_covered`` of its words,
    or the longest of them has over ``longest_floor`` words and over ``max_longest`` of the text's words.  Null and
    empty texts have zero counts and fail; repeated rows stay; other columns are ignored; long texts are read whole.
    """
    id_type = dict(docs.dtypes)[id_col]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column(1)):
                m = measure(data, offsets, min_words)
                n = m["n_words"]
                base = (n < 10) | (100 * m["n_repeat_words"] > 20 * n)
                much = m["covered_words"] > max_covered * n
                long = (m["longest_repeat"] > longest_floor) & (m["longest_repeat"] > max_longest * n)
                cols = [batch.column(0).slice(a, b - a), *[pa.array(m[c].astype(np.int64)) for c in COUNTS],
                        pa.array(base), pa.array(~(base | much | long))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", *COUNTS, "base_failed", "kept"])

    schema = f"doc_id {id_type}, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean"
    return docs.selectExpr(f"`{id_col}`", f"`{text_col}`").mapInArrow(rows, schema)
