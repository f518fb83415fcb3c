"""Exact repeats of long byte strings, by a run-length compressed Burrows-Wheeler index.

Work is cut by content.  The least ``GRAM``-byte hash inside a window of ``limit`` bytes (leftmost of equal ones) is the
window's anchor; equal windows have equal anchors at the same place, so all copies of a window meet at its anchor's
hash.  The windows of one anchor are contiguous and make a segment of text.

1. Texts are packed into chunks.  Every chunk sends each anchor hash once to the hash's bucket and learns which ones
   other chunks have too; most text is done with here.
2. Chunks send each different segment of those anchors once.  In a bucket, segments that can be a source are indexed:
   their Burrows-Wheeler transform by runs, with text positions sampled at both ends of every run, and the first place
   of each interval of suffixes that agree on ``limit`` bytes.  Segments that can have a source are streamed through it
   from their last byte to their first: matching statistics, moved on by the run ends where a byte does not fit.  A
   window that matches ``limit`` bytes at an earlier place is marked; each occurrence takes its segment's marks.
3. Chunks remove the union of their marked windows.

A passage in very many documents sends one segment per chunk.  Chunks read answers from a file of their own part of
the table; no task opens the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.hash_files import HashFiles, put
from quire.llm.store import partitions, scratch_path, written
from quire.llm.words import Ranges, mix, text_bytes

GRAM = 24
CHUNK_BYTES, BLOCK = 4 << 20, 1 << 20
BUCKET_BYTES, LINES = 1 << 20, 2048
PLACE_BITS = np.uint64(31)
NULL_ID = -(1 << 63)
CHUNK = "chunk long, ids binary, ends binary, bytes binary"
SEGMENTS = "bucket long, chunk long, h binary, id binary, row binary, at binary, lead binary, size binary, bytes binary"
SPANS = "part long, chunk long, row binary, a binary, b binary"


# ---------------------------------------------------------------- the index

class RunIndex:
    """Run-length Burrows-Wheeler index of several texts (``data`` cut at ``bounds``), each ended by a byte of its own."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, limit: int):
        size = np.diff(bounds)
        self.bounds = bounds + np.arange(len(bounds))  # of the texts with their ends
        n = len(data) + len(size)
        self.stop = self.bounds[1:] - 1
        symbol = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[self.stop] = False
        symbol[inside] = data.astype(np.int64) + 1
        self.text = np.concatenate([np.maximum(symbol - 1, 0).astype(np.uint8), np.zeros(8, np.uint8)])
        self.eight = np.ndarray(n + 1, "<u8", self.text, strides=(1,))
        self.rest = np.repeat(self.stop, size + 1) - np.arange(n)  # bytes up to the end of the text
        order, prefix = _suffixes(symbol, self.rest, limit)
        before = symbol[order - 1]  # of the first suffix: an end
        begin = np.ones(n, bool)
        begin[1:] = before[1:] != before[:-1]
        self.start = np.flatnonzero(begin)
        self.symbol = before[self.start]
        length = np.diff(np.append(self.start, n))
        self.first, self.last = order[self.start], order[self.start + length - 1]
        runs = len(self.start)
        self.by_symbol = np.argsort(self.symbol, kind="stable")
        self.key = self.symbol[self.by_symbol] * runs + self.by_symbol
        self.target = np.empty(runs, np.int64)  # where a run's first row is mapped to
        self.target[self.by_symbol] = np.cumsum(length[self.by_symbol]) - length[self.by_symbol]
        self.end = self.start + length - 1
        self.zero = order[:1]
        # intervals of two or more suffixes that agree on ``limit`` bytes, with the first place of each
        k, of = prefix
        same = of[order[1:]] == of[order[:-1]]
        tail = np.minimum(order + limit - k, n - 1)
        same &= of[tail[1:]] == of[tail[:-1]]
        joins = np.flatnonzero(same & ~np.append(False, same[:-1]))
        ends = np.flatnonzero(same & ~np.append(same[1:], False)) + 1
        self.lo, self.hi = joins, ends
        self.least = np.zeros(0, np.int64)
        if len(joins):
            self.least = np.minimum.reduceat(np.append(order, n), np.column_stack([joins, ends + 1]).ravel())[::2]

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common beginning of the suffixes at ``a`` and ``b``, as far as ``most``."""
        most = np.minimum(most, np.minimum(self.rest[a], self.rest[b]))
        out, todo, done = most.copy(), np.flatnonzero(most > 0), 0
        while len(todo):
            x = self.eight[a[todo] + done] ^ self.eight[b[todo] + done]
            low = (x & (~x + np.uint64(1))).astype(np.float64)  # the lowest differing bit
            equal = np.where(x == 0, 8, np.log2(np.maximum(low, 1)).astype(np.int64) // 8)
            out[todo] = np.minimum(out[todo], np.where(equal < 8, done + equal, out[todo]))
            done += 8
            todo = todo[(equal == 8) & (most[todo] > done)]
        return out

    def stream(self, data: np.ndarray, bounds: np.ndarray, limit: int, lengths: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of the patterns (``data`` cut at ``bounds``), all streamed at once from their last byte
        to their first: per byte the length of the longest match that begins there and, where it is ``limit`` or more,
        the first place of those ``limit`` bytes in the indexed texts (else -1).  Unless all ``lengths`` are asked for,
        a pattern is left where what is before it is too short to bring its match to ``limit``."""
        left = np.diff(bounds)  # bytes still to come
        at = bounds[1:] - 1
        runs, most = len(self.start), np.zeros(len(data), np.int64)
        firsts = np.full(len(data), -1, np.int64)
        row, length = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        place = np.repeat(self.zero, len(at))
        while True:
            on = left > 0 if lengths else length + left >= limit
            on &= left > 0
            if not on.all():
                left, at, row, length, place = left[on], at[on], row[on], length[on], place[on]
            if not len(at):
                return most, firsts
            c = data[at].astype(np.int64) + 1
            run = np.searchsorted(self.start, row, "right") - 1
            off = np.flatnonzero(self.symbol[run] != c)
            lost = off[:0]
            if len(off):  # to the nearer of the ends of the runs of c before and after
                co = c[off]
                j = np.searchsorted(self.key, co * runs + run[off])
                up, down = self.by_symbol[np.maximum(j - 1, 0)], self.by_symbol[np.minimum(j, runs - 1)]
                has_up, has_down = (j > 0) & (self.symbol[up] == co), (j < runs) & (self.symbol[down] == co)
                last, first = self.last[up], self.first[down]
                m_up = np.where(has_up, self._common(place[off], last, length[off]), -1)
                m_down = np.where(has_down, self._common(place[off], first, length[off]), -1)
                use = m_up >= m_down
                run[off] = np.where(use, up, down)
                row[off] = np.where(use, self.end[up], self.start[down])
                place[off] = np.where(use, last, first)
                length[off] = np.maximum(m_up, m_down)
                lost = off[length[off] < 0]
            row += self.target[run] - self.start[run]
            place -= 1
            length += 1
            row[lost], place[lost], length[lost] = 0, self.zero[0], 0
            most[at] = length
            hit = np.flatnonzero(length >= limit)
            if len(hit):
                firsts[at[hit]] = place[hit]
                if len(self.lo):
                    k = np.searchsorted(self.lo, row[hit], "right") - 1
                    inside = (k >= 0) & (row[hit] <= self.hi[np.maximum(k, 0)])
                    firsts[at[hit[inside]]] = self.least[k[inside]]
            at, left = at - 1, left - 1


def _suffixes(symbol: np.ndarray, rest: np.ndarray, limit: int) -> tuple[np.ndarray, tuple[int, np.ndarray]]:
    """The sorted suffixes (by doubling; the ends of texts differ and sort by place), and (k, rank of the first k
    symbols) for a k from limit / 2 to limit, or less if that tells all suffixes apart."""
    n, k = len(symbol), min(7, limit)
    key = np.zeros(n, np.int64)
    for j in range(k):
        key = (key << 9) | np.where(rest >= j, symbol[np.minimum(np.arange(n) + j, n - 1)], 0)
    order = np.argsort(key, kind="stable")
    key, ended = key[order], rest[order] < k
    fresh = np.ones(n, bool)
    fresh[1:] = (key[1:] != key[:-1]) | ended[1:]
    rank = np.zeros(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    kept = (k, rank)
    while True:
        head = np.flatnonzero(fresh)
        size = np.diff(np.append(head, n))
        todo = np.flatnonzero(np.repeat(size > 1, size))
        if not len(todo):
            return order, kept
        p = order[todo]
        group, after = rank[p], rank[np.minimum(p + k, n - 1)]
        by = np.lexsort((after, group))
        order[todo], after, group = p[by], after[by], group[by]
        new = np.ones(len(todo), bool)
        new[1:] = (after[1:] != after[:-1]) | (group[1:] != group[:-1])
        fresh[todo[new]] = True
        if kept[1] is rank:
            rank = rank.copy()  # the kept one stays as it is
        rank[order[todo]] = np.maximum.accumulate(np.where(new, todo, 0))
        k *= 2
        if k <= limit:
            kept = (k, rank)


# ---------------------------------------------------------------- anchors

def anchors(data: np.ndarray, offsets: np.ndarray, limit: int) -> tuple[np.ndarray, ...]:
    """The anchors of all windows of ``limit`` bytes inside one text: the first window's start, the last one's, the
    anchor's place, its hash and a hash of the segment; in the order of the places."""
    found = [[np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2]
    gram = min(GRAM, limit)
    w = limit - gram + 1
    for a in range(0, len(data) - limit + 1, BLOCK):
        piece = data[a: a + BLOCK + limit - 1]
        n = len(piece) - limit + 1
        lo = np.clip(offsets[:-1] - a, 0, n)
        hi = np.clip(offsets[1:] - limit + 1 - a, lo, n)
        lo, hi = lo[hi > lo], hi[hi > lo]
        if not len(lo):
            continue
        ranges = Ranges(piece)
        h = ranges.grams(gram)
        least, span = ((h >> PLACE_BITS) << PLACE_BITS) | np.arange(len(h), dtype=np.uint64), 1
        while span * 2 <= w:
            least, span = np.minimum(least[:-span], least[span:]), span * 2
        least = np.minimum(least[:n], least[w - span: w - span + n])
        depth = np.zeros(n + 1, np.int8)
        depth[lo] += 1
        depth[hi] -= 1  # where one text's windows end and the next one's begin, nothing changes
        inside = np.cumsum(depth[:-1], dtype=np.int8) > 0
        new = np.ones(n + 1, bool)
        new[1:-1] = least[1:] != least[:-1]
        new[lo] = new[hi] = True
        one, last = np.flatnonzero(new[:-1] & inside), np.flatnonzero(new[1:] & inside)
        at = (least[one] & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
        whole = mix(ranges.hashes(one, last + limit) + (at - one).astype(np.uint64))
        found.append([one + a, last + a, at + a, mix(h[at] + np.uint64(1)), whole])  # least hashes are small: spread anew
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


# ---------------------------------------------------------------- chunks

def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunk = TaskContext.get().partitionId() << 32
    for batch in batches:
        ids = batch.column(1).fill_null(NULL_ID).to_numpy()
        data, offsets = text_bytes(batch.column(0))
        row = 0
        while row < len(ids):
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
            yield pa.RecordBatch.from_arrays([
                pa.array([chunk], pa.int64()), pa.array([ids[row:end].tobytes()], pa.binary()),
                pa.array([(offsets[row: end + 1] - offsets[row]).tobytes()], pa.binary()),
                pa.array([data[offsets[row]: offsets[end]].tobytes()], pa.binary())], [x.split(" ")[0] for x in CHUNK.split(", ")])
            row, chunk = end, chunk + 1


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for i in range(batch.num_rows):
        yield (batch.column(0)[i].as_py(), np.frombuffer(batch.column(1)[i].as_buffer(), np.int64),
               np.frombuffer(batch.column(2)[i].as_buffer(), np.int64), np.frombuffer(batch.column(3)[i].as_buffer(), np.uint8))


def _cells(cuts: np.ndarray, *columns: np.ndarray) -> list[pa.Array]:
    """Each column cut into one binary cell per group."""
    return [pa.array([c[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()) for c in columns]


def _values(column: pa.ChunkedArray, dtype: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *[np.frombuffer(x.as_buffer(), dtype) for x in column]])


def _bits(size: float) -> int:
    """Leading bits of a hash that cut ``size`` bytes into buckets of about ``BUCKET_BYTES``."""
    return max(2, int(size // BUCKET_BYTES).bit_length())


def _bucket_cuts(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    bucket = (h >> np.uint64(64 - bits)).astype(np.int64)
    new = np.ones(len(h), bool)
    new[1:] = bucket[1:] != bucket[:-1]
    cut = np.flatnonzero(new)
    return bucket[cut], np.append(cut, len(h))


def _put_parts(table: pa.Table, uri: str, columns: dict[str, str]) -> pa.Table:
    """One file per column with the cells of a part's chunks in a row, the chunks, and where each begins."""
    part, table = table["part"][0].as_py(), table.sort_by("chunk")
    chunk = table["chunk"].to_numpy()
    first = next(iter(columns))
    n = np.array([len(x.as_buffer()) for x in table[first]], np.int64) // np.dtype(columns[first]).itemsize
    new = np.ones(len(chunk), bool)
    new[1:] = chunk[1:] != chunk[:-1]
    put(uri, f"p-{part}-chunk", chunk[new])
    put(uri, f"p-{part}-cut", np.append((np.cumsum(n) - n)[new], n.sum()))
    for name, dtype in columns.items():
        put(uri, f"p-{part}-{name}", _values(table[name], dtype))
    return pa.table({"n": pa.array([int(n.sum())], pa.int64())})


def _of_chunk(files: HashFiles, chunk: int, columns: dict[str, str]) -> list[np.ndarray]:
    part = chunk >> 32
    have, cut = files.array(f"p-{part}-chunk", "<i8"), files.array(f"p-{part}-cut", "<i8")
    at = int(np.searchsorted(have, chunk))
    a, b = (cut[at], cut[at + 1]) if at < len(have) and have[at] == chunk else (0, 0)
    return [files.array(f"p-{part}-{name}", dtype)[a:b] for name, dtype in columns.items()]


# ---------------------------------------------------------------- the three passes

def _anchor_hashes(bits: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, _, ends, data in _unpacked(batch):
                h = np.unique(anchors(data, ends, limit)[3])
                bucket, cuts = _bucket_cuts(h, bits)
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket), pa.array(np.full(len(bucket), chunk)), *_cells(cuts, h)], ["bucket", "chunk", "h"])

    return run


def _shared(table: pa.Table) -> pa.Table:
    """Per chunk, the bucket's hashes that another chunk has too."""
    n = np.array([len(x.as_buffer()) for x in table["h"]], np.int64) // 8
    h, chunk = _values(table["h"], "<u8"), np.repeat(table["chunk"].to_numpy(), n)
    by = np.argsort(h, kind="stable")
    h, chunk = h[by], chunk[by]
    same = h[1:] == h[:-1]
    shared = np.append(same, False) | np.append(False, same)
    h, chunk = h[shared], chunk[shared]
    by = np.argsort(chunk, kind="stable")
    h, chunk = h[by], chunk[by]
    new = np.ones(len(h), bool)
    new[1:] = chunk[1:] != chunk[:-1]
    cut = np.flatnonzero(new)
    return pa.table({"part": pa.array(chunk[cut] >> 32), "chunk": pa.array(chunk[cut]),
                     "h": _cells(np.append(cut, len(h)), h)[0]})


def _segments(uri: str, bits: int, limit: int):
    """A chunk's different segments at anchors that occur elsewhere, and (bucket below 0) the spans of segments that
    the chunk itself has earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, names = HashFiles(uri, 0), [x.split(" ")[0] for x in SEGMENTS.split(", ")]
        for batch in batches:
            for chunk, ids, ends, data in _unpacked(batch):
                first, last, at, h, whole = anchors(data, ends, limit)
                value, back, count = np.unique(h, return_inverse=True, return_counts=True)
                shared = np.isin(value, _of_chunk(files, chunk, {"h": "<u8"})[0]) | (count > 1)
                row = np.searchsorted(ends, first, "right") - 1
                on = np.flatnonzero(shared[back])
                on = on[np.lexsort((at[on], row[on], ids[row[on]]))]  # by (id, place)
                lead = np.unique(whole[on], return_index=True)[1]
                rest = np.delete(on, lead)
                if len(rest):
                    a, b = first[rest] - ends[row[rest]], last[rest] + limit - ends[row[rest]]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([-1 - (chunk & 0xFFFF)], pa.int64()), pa.array([chunk], pa.int64()), *[pa.array([b""], pa.binary())] * 2,
                        pa.array([row[rest].astype("<u4").tobytes()], pa.binary()), *[pa.array([x.astype("<u4").tobytes()], pa.binary()) for x in (a, b)],
                        *[pa.array([b""], pa.binary())] * 2], names)
                on = on[lead]
                on = on[np.argsort(h[on], kind="stable")]
                if len(on):
                    bucket, cuts = _bucket_cuts(h[on], bits)
                    size = last[on] + limit - first[on]
                    base = np.cumsum(size) - size
                    text = data[np.arange(size.sum()) + np.repeat(first[on] - base, size)]
                    packed = [pa.compress(text[a:b].tobytes(), "zstd", asbytes=True) for a, b in zip(
                        base[cuts[:-1]], np.append(base, len(text))[cuts[1:]], strict=True)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(bucket), pa.array(np.full(len(bucket), chunk)),
                        *_cells(cuts, h[on], ids[row[on]], row[on].astype("<u4"), (at[on] - ends[row[on]]).astype("<u4"),
                                (at[on] - first[on]).astype("<u2"), size.astype("<u2")), pa.array(packed, pa.binary())], names)

    return run


def _spans_out(chunk: np.ndarray, row: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Table:
    by = np.argsort(chunk, kind="stable")
    chunk, row, a, b = chunk[by], row[by], a[by], b[by]
    new = np.ones(len(chunk), bool)
    new[1:] = chunk[1:] != chunk[:-1]
    cut = np.flatnonzero(new)
    cells = _cells(np.append(cut, len(chunk)), row.astype("<u4"), a.astype("<u4"), b.astype("<u4"))
    return pa.table({"part": pa.array(chunk[cut] >> 32), "chunk": pa.array(chunk[cut]), **dict(zip(("row", "a", "b"), cells, strict=True))})


def _runs(flag: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of set places inside the texts cut at ``bounds``: text, start and end, counted from the text's start."""
    edge = flag.copy()
    edge[1:] &= ~flag[:-1]
    starts = bounds[:-1][bounds[:-1] < len(flag)]
    edge[starts] = flag[starts]
    done = flag.copy()
    done[:-1] &= ~flag[1:]
    ends = bounds[1:][bounds[1:] > 0] - 1
    done[ends] = flag[ends]
    a, b = np.flatnonzero(edge), np.flatnonzero(done) + 1
    of = np.searchsorted(bounds, a, "right") - 1
    return of, a - bounds[of], b - bounds[of]


def _select(data: np.ndarray, bounds: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.diff(bounds)[which]
    out = np.append(0, np.cumsum(size))
    return data[np.arange(out[-1]) + np.repeat(bounds[which] - out[:-1], size)], out


def _mark(limit: int):
    def run(table: pa.Table) -> pa.Table:
        if table["bucket"][0].as_py() < 0:
            out = {c: table[c] for c in ("chunk", "row")}
            return pa.table({"part": pa.array(table["chunk"].to_numpy() >> 32), **out, "a": table["at"], "b": table["lead"]})
        n = np.array([len(x.as_buffer()) for x in table["h"]], np.int64) // 8
        chunk = np.repeat(table["chunk"].to_numpy(), n)
        h, ids, row, at, lead, size = (_values(table[c], t) for c, t in (
            ("h", "<u8"), ("id", "<i8"), ("row", "<u4"), ("at", "<u4"), ("lead", "<u2"), ("size", "<u2")))
        at, lead, size, row = (x.astype(np.int64) for x in (at, lead, size, row))
        start = np.cumsum(size) - size
        total = np.append(np.cumsum(n), 0)
        texts, taken = [], 0
        for i, x in enumerate(table["bytes"]):
            many = int(size[taken: total[i]].sum())
            texts.append(np.frombuffer(pa.decompress(x.as_buffer(), many, "zstd"), np.uint8))
            taken = int(total[i])
        text = np.concatenate(texts)
        by = np.lexsort((at, row, chunk, ids))  # occurrences by (id, place)
        h, row, at, lead, size, start, chunk = (x[by] for x in (h, row, at, lead, size, start, chunk))
        # contents: equal bytes with the anchor at the same place, in the order of their first occurrence
        wide = np.zeros((len(h), int(size.max()) + 4), np.uint8)
        wide[:, :2], wide[:, 2:4] = lead.astype("<u2").view(np.uint8).reshape(-1, 2), size.astype("<u2").view(np.uint8).reshape(-1, 2)
        for a in range(0, len(h), LINES):
            some, from_ = size[a: a + LINES], start[a: a + LINES]
            line = np.repeat(np.arange(a, a + len(some)), some)
            col = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
            wide[line, col + 4] = text[np.repeat(from_, some) + col]
        _, first, content, count = np.unique(wide.view(f"V{wide.shape[1]}").ravel(), return_index=True, return_inverse=True, return_counts=True)
        del wide
        by = np.argsort(first)
        rank = np.empty_like(by)
        rank[by] = np.arange(len(by))
        content, first, count = rank[content], first[by], count[by]
        bounds = np.append(0, np.cumsum(size[first]))
        text = text[np.arange(bounds[-1]) + np.repeat(start[first] - bounds[:-1], size[first])]
        _, group = np.unique(h[first], return_inverse=True)
        leads = np.zeros(len(first), bool)
        leads[np.unique(group, return_index=True)[1]] = True
        tails = np.zeros(len(first), bool)
        tails[len(group) - 1 - np.unique(group[::-1], return_index=True)[1]] = True
        sources = np.flatnonzero(~tails | (count > 1))
        seekers = np.flatnonzero(~leads | (count > 1))
        if not len(sources) or not len(seekers):
            return _spans_out(*[np.zeros(0, np.int64)] * 4)
        index = RunIndex(*_select(text, bounds, sources), limit)
        pattern, cuts = _select(text, bounds, seekers)
        _, place = index.stream(pattern, cuts, limit)
        of = np.where(place >= 0, sources[np.searchsorted(index.bounds, place, "right") - 1], len(first))
        own = np.repeat(seekers, np.diff(cuts))
        where = np.full(len(first), -1)
        where[seekers] = np.arange(len(seekers))
        out = []
        later = np.ones(len(h), bool)
        later[first] = False
        for flag, some in ((of < own, np.flatnonzero(~later)), (place >= 0, np.flatnonzero(later))):
            text_of, a, b = _runs(flag, cuts)
            cut = np.searchsorted(text_of, np.arange(len(seekers) + 1))
            some = some[where[content[some]] >= 0]
            many = np.diff(cut)[where[content[some]]]
            at_run = np.arange(many.sum()) + np.repeat(cut[where[content[some]]] - np.cumsum(many) + many, many)
            some = np.repeat(some, many)
            base = at[some] - lead[some]
            out.append((chunk[some], row[some], base + a[at_run], base + b[at_run] - 1 + limit))
        return _spans_out(*(np.concatenate(x) for x in zip(*out, strict=True)))

    return run


def _remove(uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = HashFiles(uri, 0)
        for batch in batches:
            for chunk, ids, ends, data in _unpacked(batch):
                row, a, b = _of_chunk(files, chunk, {"row": "<u4", "a": "<u4", "b": "<u4"})
                depth = np.zeros(len(data) + 1, np.int32)
                base = ends[row.astype(np.int64)]
                np.add.at(depth, base + a, 1)
                np.add.at(depth, base + b, -1)
                gone = np.cumsum(depth[:-1]) > 0
                of, lo, hi = _runs(gone, ends)
                cut = np.searchsorted(of, np.arange(len(ids) + 1)).astype(np.int32)
                kept = np.append(0, np.cumsum(~gone))[ends]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, mask=ids == NULL_ID), pa.array(np.diff(ends)),
                    pa.ListArray.from_arrays(pa.array(cut), pa.StructArray.from_arrays([pa.array(lo), pa.array(hi)], ["start", "end"])),
                    pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(kept), pa.py_buffer(data[~gone])]).cast(pa.binary())],
                    ["doc_id", "n_bytes", "spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, limit: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc_id, n_bytes, spans, kept) per row of ``docs``: ``spans`` are the maximal byte ranges, as an array of
    (start, end), covered by a string of ``limit`` bytes that also starts earlier (in a row with a smaller id, or
    earlier in the same row); ``kept`` are the other bytes.  Strings are judged on the input and lie in one text.

    Null texts count as empty; a null id is the least; rows with the same id follow each other by their place in the
    table, so of equal rows one stays whole; texts shorter than ``limit`` stay; other columns are ignored; an empty
    table gives an empty result."""
    spark: SparkSession = docs.sparkSession
    read = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{id_col}`").cast("long").alias("id"))
    chunks = written(read.mapInArrow(_pack, CHUNK), "chunks", "zstd")
    total = chunks.agg(F.sum(F.length("bytes"))).first()[0] or 0
    w = max(2, limit - GRAM + 2) / 2  # bytes per anchor
    answers = scratch_path(spark, "anchors")
    shared = chunks.mapInArrow(_anchor_hashes(_bits(total / w * 8), limit), "bucket long, chunk long, h binary") \
        .groupBy("bucket").applyInArrow(_shared, "part long, chunk long, h binary") \
        .groupBy("part").applyInArrow(lambda t: _put_parts(t, answers, {"h": "<u8"}), "n long").agg(F.sum("n")).first()[0] or 0
    marks = scratch_path(spark, "spans")
    spans = {"row": "<u4", "a": "<u4", "b": "<u4"}
    chunks.mapInArrow(_segments(answers, _bits(shared * (limit + w + 26)), limit), SEGMENTS) \
        .groupBy("bucket").applyInArrow(_mark(limit), SPANS) \
        .groupBy("part").applyInArrow(lambda t: _put_parts(t, marks, spans), "n long").agg(F.sum("n")).collect()
    out = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    return chunks.mapInArrow(_remove(marks), out)
