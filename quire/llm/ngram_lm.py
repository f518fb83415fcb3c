"""Interpolated modified Kneser-Ney n-gram model: counted in Spark, stored as sorted hash arrays, memory-mapped.

Counting: every task turns its training texts into distinct n-grams of the highest order with counts, cut into buckets
by the word before the last, which every context of two or more words ends in.  So the lower orders need no
rows of their own: a bucket's task merges its n-grams, sorted by (word before the last, last word, words further back),
and each order is a prefix of those columns.  The highest order has raw counts, lower orders have the numbers of
distinct preceding words; single words sum theirs over the buckets.  Counts are written once to the shared folder and
discounted when a text is scored.

Files of an order and bucket (whole files, put in place by a rename, so a repeated task leaves the same files):
n-grams and contexts as sorted 64-bit hashes, of which a directory of slots of 8 to 16 keys holds the leading bits and an
array the next 32; so a key that was not counted is taken for one that was with odds of about 2**-28 at any size of the
corpus.  Counts take a byte, larger ones a list beside them; a context has the number of its row among the bucket's
distinct (sum, ones, twos, more).  Scoring maps the files into memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import words as W
from quire.llm.hash_files import HashFiles, bucket_bits, cut_points, put
from quire.llm.store import partitions, scratch_path

FLUSH_TOKENS = 4_000_000
SCORE_BYTES = 4 << 20
END, BEGIN = np.uint64(0xE5D0C3B2A1908F7E), np.uint64(0x1B2C3D4E5F607182)
FACTOR = np.uint64(0x9E3779B97F4A7C15)
ODD = W.mix(np.arange(1, 5, dtype=np.uint64)) | np.uint64(1)  # a row of four numbers is told by one sum of multiples
RAW = 0  # kind of table: 0 raw token counts, k > 0 the model's table of order k


def token_stream(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words followed by its end, and the bounds of each text."""
    n = len(words.count)
    bounds = words.bounds + np.arange(n + 1)
    stream = np.empty(bounds[-1], np.uint64)
    is_end = np.zeros(len(stream), bool)
    is_end[bounds[1:] - 1] = True
    stream[is_end] = END
    stream[~is_end] = words.hashes(lower=True)
    return stream, bounds


def back(stream: np.ndarray, bounds: np.ndarray, step: int) -> np.ndarray:
    """The value ``step`` places before each token of ``stream``; its last value is that of places before a text."""
    tokens = stream[:-1]
    out = np.full(len(tokens), stream[-1], stream.dtype)
    if step < len(tokens):
        out[step:] = tokens[: len(tokens) - step]
    first = np.repeat(bounds[:-1], np.diff(bounds))
    out[np.arange(len(tokens)) - step < first] = stream[-1]
    return out


def chain(last: np.ndarray, word: np.ndarray, before: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the context and of the n-gram: ``last`` is the context's last word, ``before`` those before it."""
    context = W.mix(last * FACTOR)
    for w in before[: order - 2]:
        context = W.mix(context * FACTOR + w.astype(np.uint64))
    return context, W.mix((context + word.astype(np.uint64)) * FACTOR)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed cell, each by the planes of its bytes; a column's name holds its type."""
    planes = [np.ascontiguousarray(x).view("u1").reshape(len(x), x.itemsize).T.tobytes() for x in arrays]
    batch = pa.RecordBatch.from_arrays([pa.array([x], pa.large_binary()) for x in planes],
                                       [f"{i}{x.dtype.str}" for i, x in enumerate(arrays)])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(cell: pa.Scalar) -> list[np.ndarray]:
    batch = pa.ipc.open_stream(cell.as_buffer()).read_next_batch()
    out = []
    for name, column in zip(batch.schema.names, batch.columns, strict=True):
        dtype = np.dtype(name.lstrip("0123456789"))
        planes = np.frombuffer(column[0].as_buffer(), "u1").reshape(dtype.itemsize, -1)
        out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(-1))
    return out


def steps(x: np.ndarray) -> np.ndarray:
    """Sorted numbers as differences, which pack smaller; ``summed`` is the way back."""
    return np.diff(x, prepend=x.dtype.type(0))


def summed(x: np.ndarray) -> np.ndarray:
    return np.cumsum(x, dtype=x.dtype)


def _starts(columns: list[np.ndarray]) -> np.ndarray:
    """Where rows of sorted columns differ from the row before."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])))


def _sum_by_key(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows in order (by the first column, then the next) and the sums of their counts."""
    order = np.lexsort(columns[::-1])
    columns, counts = [c[order] for c in columns], counts[order]
    at = _starts(columns)
    return [c[at] for c in columns], np.add.reduceat(counts, at) if len(at) else counts


def _grams(ranks: np.ndarray, bounds: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows (word before the last, last word, words further back) of ranks, in order, and their counts."""
    columns = [back(ranks, bounds, 1), ranks[:-1], *[back(ranks, bounds, j) for j in range(2, order)]]
    width = int(ranks.max()).bit_length()
    if width * order > 64:
        return _sum_by_key(columns, np.ones(len(ranks) - 1, np.int64))
    code = np.zeros(len(ranks) - 1, np.uint64)
    for c in columns:
        code = code << np.uint64(width) | c.astype(np.uint64)
    code.sort()
    at = _starts([code])
    mask, code, counts = np.uint64((1 << width) - 1), code[at], np.diff(np.append(at, len(code)))
    return [(code >> np.uint64(width * (order - 1 - i)) & mask).astype(np.int64) for i in range(order)], counts


CELLS = "kind int, bucket int, cell binary"
NAMES = ["kind", "bucket", "cell"]


def _cells(kind: int, buckets: list[int], cells: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kind] * len(cells), pa.int32()), pa.array(buckets, pa.int32()),
                                       pa.array(cells, pa.binary())], NAMES)


def _count(batches: Iterator[pa.RecordBatch], order: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Cells of words with counts (kind 0) and of n-grams of the highest order with counts (kind ``order``)."""
    def flush(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        ends = np.concatenate([np.zeros(1, np.int64), *[np.diff(b) for _, b in parts]]).cumsum()
        words, ranks = np.unique(np.concatenate([*[s for s, _ in parts], [BEGIN]]), return_inverse=True)
        counts = np.bincount(ranks[:-1], minlength=len(words)).astype("<u4")
        cuts = cut_points(words, bits)
        full = [i for i in range(1 << bits) if counts[cuts[i]: cuts[i + 1]].any()]
        kept = [cuts[i] + np.flatnonzero(counts[cuts[i]: cuts[i + 1]]) for i in full]
        yield _cells(RAW, full, [pack(steps(words[k]), counts[k]) for k in kept])
        if order == 1:
            return
        columns, counts = _grams(ranks, ends, order)
        ids = (words >> np.uint64(32)).astype("<u4")
        at = np.searchsorted(columns[0], cuts)
        for i in range(1 << bits):
            cut = slice(at[i], at[i + 1])
            if at[i] == at[i + 1]:
                continue
            lasts, runs = np.unique(columns[0][cut], return_counts=True)
            used = np.zeros(len(words), bool)
            for c in columns[1:]:
                used[c[cut]] = True
            place = used.cumsum() - 1
            small = "<u2" if place[-1] < 1 << 16 else "<u4"
            yield _cells(order, [i], [pack(steps(words[lasts]), runs.astype("<u4"), steps(ids[used]), counts[cut].astype("<u4"),
                                           *[place[c[cut]].astype(small) for c in columns[1:]])])

    parts, size = [], 0
    for batch in batches:
        for _, _, data, offsets in W.chunks(batch.column(0)):
            parts.append(token_stream(W.Words(data, offsets)))
            size += len(parts[-1][0])
            if size >= FLUSH_TOKENS:
                yield from flush(parts)
                parts, size = [], 0
    if parts:
        yield from flush(parts)


def _put_keys(uri: str, name: str, keys: np.ndarray) -> None:
    """Sorted 64-bit ``keys``: a directory of their leading bits and an array of the 32 bits that follow."""
    q = max(0, len(keys).bit_length() - 4)
    slots = keys >> np.uint64(64 - q) if q else np.zeros(len(keys), np.uint64)
    put(uri, f"{name}-d", np.searchsorted(slots, np.arange((1 << q) + 1, dtype=np.uint64)).astype("<u4"))
    put(uri, f"{name}-k", (keys << np.uint64(q) >> np.uint64(32)).astype("<u4"))


def _put_counts(uri: str, name: str, counts: np.ndarray) -> None:
    put(uri, f"{name}-c", np.minimum(counts, 255).astype("u1"))
    large = np.flatnonzero(counts >= 255)
    put(uri, f"{name}-o", np.concatenate([large, counts[large]]).astype("<i8"))


def _find(files: HashFiles, name: str, keys: np.ndarray) -> np.ndarray:
    """The place of each of ``keys`` among those written as ``name``, -1 if it is not there."""
    have, slots = files.array(f"{name}-k", "<u4"), files.array(f"{name}-d", "<u4")
    if not len(have):
        return np.full(len(keys), -1)
    q = (len(slots) - 1).bit_length() - 1
    slot = (keys >> np.uint64(64 - q)).astype(np.int64) if q else np.zeros(len(keys), np.int64)
    rest = (keys << np.uint64(q) >> np.uint64(32)).astype("<u4")
    low, end = slots[slot].astype(np.int64), slots[slot + 1].astype(np.int64)
    high = end.copy()
    while (going := low < high).any():
        middle = (low + high) // 2
        less = going & (have[np.minimum(middle, len(have) - 1)] < rest)
        high = np.where(going & ~less, middle, high)
        low = np.where(less, middle + 1, low)
    return np.where((low < end) & (have[np.minimum(low, len(have) - 1)] == rest), low, -1)


def _counts(files: HashFiles, name: str, at: np.ndarray) -> np.ndarray:
    """Counts at places that ``_find`` gave; 0 where it is -1."""
    have = files.array(f"{name}-c", "u1")
    if not len(have):
        return np.zeros(len(at), np.int64)
    out = np.where(at < 0, 0, have[at]).astype(np.int64)
    if (large := out == 255).any():
        place, value = files.array(f"{name}-o", "<i8").reshape(2, -1)
        out[large] = value[np.searchsorted(place, at[large])]
    return out


MERGED = "kind int, bucket int, cell binary, total long, n_keys long, n1 long, n2 long, n3 long, n4 long"


def _noted(kind: int, bucket: int, counts: np.ndarray) -> list:
    """A row of MERGED: totals of a table, and how many of its keys have a count of 1, 2, 3 and 4."""
    return [kind, bucket, None, int(counts.sum()), len(counts), *np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()]


def _table(rows: list[list]) -> pa.Table:
    types = [pa.int32(), pa.int32(), pa.binary(), *[pa.int64()] * 6]
    names = [x.split()[0] for x in MERGED.split(", ")]
    return pa.table({n: pa.array(list(c), t) for n, c, t in zip(names, zip(*rows, strict=True), types, strict=True)})


def single_bits(bits: int) -> int:
    """Leading bits that cut single words: vocabularies grow about as the root of a corpus, and so the cells of words
    that go from each bucket of n-grams to each of theirs stay far below the square of the buckets."""
    return (bits + 1) // 2


def _singles(ids: np.ndarray, counts: np.ndarray, bits: int) -> list[list]:
    """Rows with cells of single words' counts, one for each bucket of the words; ``ids`` are sorted."""
    cuts = np.searchsorted(ids, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32 - bits))
    return [[1, i, pack(steps(ids[cuts[i]: cuts[i + 1]]), counts[cuts[i]: cuts[i + 1]].astype("<i8")), *[0] * 6]
            for i in range(1 << bits) if cuts[i] < cuts[i + 1]]


def _merge(table: pa.Table, order: int, bits: int, uri: str) -> pa.Table:
    """Merges a bucket's cells and writes its files; returns the totals of each table and cells of single words."""
    kind, bucket = table["kind"][0].as_py(), table["bucket"][0].as_py()
    cells = [unpack(c) for c in table["cell"]]
    if kind == RAW:
        (words,), counts = _sum_by_key([np.concatenate([summed(c[0]) for c in cells])],
                                       np.concatenate([c[1] for c in cells]).astype(np.int64))
        put(uri, f"{RAW}-{bucket}-k", words)
        put(uri, f"{RAW}-{bucket}-v", np.minimum(counts, 2**32 - 1).astype("<u4"))
        rows = [_noted(RAW, bucket, counts)]
        if order == 1:
            (ids,), counts = _sum_by_key([(words >> np.uint64(32)).astype("<u4")], counts)
            rows += _singles(ids, counts, single_bits(bits))
        return _table(rows)

    parts, sums = [], []
    for lasts, runs, ids, counts, *columns in cells:
        ids = summed(ids)
        sums.append(counts.astype(np.int64))
        parts.append([np.repeat(summed(lasts), runs), *[ids[c] for c in columns]])
    grams, counts = _sum_by_key([np.concatenate(c) for c in zip(*parts, strict=True)], np.concatenate(sums))
    rows = []
    for k in range(order, 1, -1):
        name = f"{k}-{bucket}"
        context, key = chain(grams[0], grams[1], grams[2:], k)
        at = np.argsort(key)
        _put_keys(uri, name, key[at])
        _put_counts(uri, name, counts[at])
        contexts, of = np.unique(context, return_inverse=True)
        facts = np.stack([np.bincount(of, x).astype("<i8") for x in (counts, counts == 1, counts == 2, counts > 2)])
        _, first, row = np.unique((facts.astype(np.uint64) * ODD[:, None]).sum(axis=0), return_index=True, return_inverse=True)
        _put_keys(uri, f"x{name}", contexts)
        put(uri, f"x{name}-r", row.astype("<u4" if len(first) > 1 << 16 else "<u2"))
        put(uri, f"x{name}-f", facts[:, first])
        rows.append(_noted(k, bucket, counts))
        if k > 2:  # the next order's n-grams: each counts its distinct words before
            at = _starts(grams[: k - 1])
            counts = np.diff(np.append(at, len(counts)))
            grams = [g[at] for g in grams[: k - 1]]
    (ids,), counts = _sum_by_key([grams[1]], np.ones(len(grams[1]), np.int64))
    return _table(rows + _singles(ids, counts, single_bits(bits)))


def _merge_singles(table: pa.Table, uri: str) -> pa.Table:
    """Writes a bucket of single words; totals of other tables pass as they are."""
    if table["cell"][0].as_py() is None:
        return table
    cells = [unpack(c) for c in table["cell"]]
    (ids,), counts = _sum_by_key([np.concatenate([summed(c[0]) for c in cells])], np.concatenate([c[1] for c in cells]))
    name, keys = f"1-{table['bucket'][0].as_py()}", W.mix(ids.astype(np.uint64) * FACTOR)
    at = np.argsort(keys)
    _put_keys(uri, name, keys[at])
    _put_counts(uri, name, counts[at])
    return _table([_noted(1, table['bucket'][0].as_py(), counts)])


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Chen and Goodman's discounts for counts 1, 2 and 3 or more; 0.5, 1 and 1.5 where they are undefined."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(d if 0 < d < i + 1 else (i + 1) / 2 for i, d in enumerate(raw))


@dataclass(frozen=True)
class Model:
    """Where the arrays of a trained model are, its discounts for counts 0, 1, 2 and more, and its few totals."""

    uri: str
    order: int
    bits: int
    train_tokens: int
    vocabulary: int
    cuts: dict[int, tuple[float, ...]]
    single_total: int
    single_rest: float  # the mass that discounts of single words leave for the uniform distribution


def train(texts: DataFrame, order: int = 3) -> Model:
    """The model of ``texts`` (its first column); null and empty texts are an end token only."""
    spark = texts.sparkSession
    bits = min(16, bucket_bits(partitions(spark)))
    uri = scratch_path(spark, "lm-model")
    sparse = texts.mapInArrow(lambda it: _count(it, order, bits), CELLS)
    merged = sparse.groupBy("kind", "bucket").applyInArrow(lambda t: _merge(t, order, bits, uri), MERGED)
    # totals (cell null) have the bucket they are of, so they are dealt as the cells are
    done = merged.groupBy("kind", "bucket").applyInArrow(lambda t: _merge_singles(t, uri), MERGED)
    sums = {r.kind: r for r in done.groupBy("kind").agg(  # one row per order
        *[F.sum(c).alias(c) for c in ("total", "n_keys", "n1", "n2", "n3", "n4")]).collect()}
    if not sums:
        return Model(uri, order, bits, 0, 0, {k: (0.0,) * 4 for k in range(1, order + 1)}, 1, 1.0)
    cuts = {k: (0.0, *discounts(r.n1, r.n2, r.n3, r.n4)) for k, r in sums.items() if k != RAW}
    u, d = sums[1], cuts[1]
    rest = (d[1] * u.n1 + d[2] * u.n2 + d[3] * (u.n_keys - u.n1 - u.n2)) / u.total
    return Model(uri, order, bits, sums[RAW].total, sums[RAW].n_keys, cuts, u.total, rest)


def _by_bucket(hashes: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """The places of ``hashes`` with the same leading bits."""
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    at = np.append(_starts([bucket[order]]), len(order))
    for a, b in zip(at[:-1], at[1:], strict=True):
        yield int(bucket[order[a]]), order[a:b]


def score_chunk(m: Model, files: HashFiles, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per text: tokens, known tokens, base score, model score."""
    def discounted(kind: int, name: str, keys: np.ndarray) -> np.ndarray:
        found = _counts(files, name, _find(files, name, keys))
        return found - np.array(m.cuts[kind])[np.minimum(found, 3)]

    stream, bounds = token_stream(W.Words(data, offsets))
    word, back_to = np.unique(stream, return_inverse=True)
    count = files.look(word, str(RAW), "k", {"v": ("<u4", 0)})[0].astype(np.float64)
    base = np.log10((count + 1) / (m.train_tokens + m.vocabulary + 1))
    single = np.empty(len(word))
    for b, at in _by_bucket(word, single_bits(m.bits)):
        single[at] = discounted(1, f"1-{b}", W.mix((word[at] >> np.uint64(32)) * FACTOR)) / m.single_total
    p = (single + m.single_rest / (m.vocabulary + 1))[back_to]
    padded = np.append(stream, BEGIN)
    last, ids = back(padded, bounds, 1), stream >> np.uint64(32)
    before = [back(padded, bounds, j) >> np.uint64(32) for j in range(2, m.order)]
    for b, at in _by_bucket(last, m.bits) if m.order > 1 else ():
        for order in range(2, m.order + 1):
            name = f"{order}-{b}"
            context, key = chain(last[at], ids[at], [x[at] for x in before], order)
            place = _find(files, f"x{name}", context)
            seen = np.flatnonzero(place >= 0)
            if not len(seen):
                break
            rows = files.array(f"x{name}-f", "<i8").reshape(4, -1)
            total, *few = rows[:, files.array(f"x{name}-r", "<u4" if rows.shape[1] > 1 << 16 else "<u2")[place[seen]]]
            rest = sum(d * n for d, n in zip(m.cuts[order][1:], few, strict=True)) / total
            to = at[seen]
            p[to] = discounted(order, name, key[seen]) / total + rest * p[to]
    sums = [np.add.reduceat(x, bounds[:-1]) for x in ((count > 0)[back_to].astype(np.int64), base[back_to], np.log10(p))]
    return (np.diff(bounds), *sums)


def score(docs: DataFrame, model: Model, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """``keep``'s columns with n_tokens, n_known, train_tokens, base_score and score of each row's text.

    Null and empty texts have one token, their end.  Tokens are lower-cased (A-Z) words and the end; base_score is
    the add-one unigram log10 probability, score the model's.  Rows stay as they are, repeated ones too.
    """
    rows = docs.select(*[c.alias(n) for n, c in keep.items()], F.col(f"`{text_col}`").alias("text"))
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = HashFiles(model.uri, model.bits)
        for batch in batches:
            for a, b, data, offsets in W.chunks(batch.column(batch.num_columns - 1), SCORE_BYTES):
                n, known, base, own = score_chunk(model, files, data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(a, b - a) for c in batch.columns[:-1]], pa.array(n.astype(np.int64)), pa.array(known),
                     pa.array([model.train_tokens] * (b - a), pa.int64()), pa.array(base), pa.array(own)],
                    [*batch.schema.names[:-1], "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return rows.mapInArrow(run, f"{schema}, n_tokens long, n_known long, train_tokens long, base_score double, score double")


