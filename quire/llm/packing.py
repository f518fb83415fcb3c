"""Mixture-controlled packing by deficit round-robin over source queues.

A source's documents form one queue of token ids.  With every token that is packed, each source earns its target
share; a sequence serves each source, in one part, the tokens that are due by its end.  When a token is due is known in
closed form, so the parts of every sequence follow from the sources' totals and targets alone, by exact integer
arithmetic.  Deficits are thus carried across sequences and partitions without any task that sees the whole
stream: texts are tokenized once and stored, token counts per (stored partition, source) give each document its
place in its queue, and a second pass over the stored ids cuts the pieces.  No ids are shuffled.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import words as W
from quire.llm.store import written

if TYPE_CHECKING:
    from tiktoken import Encoding

PIECE = ("doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
         "source string")
CALL_BYTES = 1 << 20  # of texts or ids that are worked on at once
END_OF_TEXT = "<|endoftext|>"
_ENCODERS: dict[str, Encoding] = {}
# Unicode's White_Space, as the pattern's \s; the pattern's look-ahead runs out of stack on about a million of them
_LONG_BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{100000,}")


def _encoder(tokenizer: str) -> Encoding:
    """This worker's tokenizer; its own special token is recognised in texts, as by the ``tokenizers`` library."""
    if tokenizer not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(tokenizer), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODERS[tokenizer] = tiktoken.Encoding(
            tokenizer, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: len(ranks)})
    return _ENCODERS[tokenizer]


def _forget_encoders() -> None:
    """A worker that has ended the first pass holds a tokenizer, which the second does not need."""
    _ENCODERS.clear()


def encoded(encoder: Encoding, text: str) -> np.ndarray:
    """The ids of ``text``; one with white space too long for the pattern is cut where the pattern cuts it: a run is
    one piece, but for its last character where other text follows."""
    try:
        return encoder.encode_to_numpy(text, allowed_special="all").astype("<u4")
    except ValueError:
        parts, at = [], 0
        for run in _LONG_BLANK.finditer(text):
            stop = run.end()
            if stop < len(text) and not text.startswith(END_OF_TEXT, stop):
                stop -= 1
            parts.append(encoder.encode_to_numpy(text[at: run.start()], allowed_special="all").astype("<u4"))
            parts.append(np.array(encoder._encode_single_piece(text[run.start(): stop].encode()), "<u4"))
            at = stop
        if not at:
            raise
        return np.concatenate([*parts, encoder.encode_to_numpy(text[at:], allowed_special="all").astype("<u4")])


def _calls(sizes: np.ndarray, limit: int = CALL_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, number of rows) of runs of rows of about ``limit`` bytes; a larger row is alone."""
    ends, row = np.cumsum(sizes), 0
    while row < len(sizes):
        end = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + limit, "right")))
        yield row, end - row
        row = end


def tokenize(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, source, part, row, queue, n, ids): ``queue`` counts the source's tokens before it in this part.

    ``tokenizer`` names a file of ranks in the installed ``public_tokenizers`` package, so every worker finds its own
    copy.  The ids are those of the ``tokenizers`` library for the same vocabulary (add_special_tokens=False); tests
    compare them.
    Ids are little-endian unsigned numbers, of 16 bits where the whole vocabulary fits, else of 32.
    """
    id_type = dict(docs.dtypes)["doc_id"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        kind = "<u2" if max(encoder.n_vocab, end_id + 1) <= 1 << 16 else "<u4"
        end = np.array([end_id], kind).tobytes()
        part, row, queues = TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            for a, many in _calls(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy().astype(np.int64)):
                some = batch.slice(a, many)
                texts = ["" if t is None else t for t in some.column(2).to_pylist()]
                sources = some.column(1).to_pylist()
                ids = [encoded(encoder, t).astype(kind).tobytes() + end for t in texts]
                counts = [len(x) // len(end) for x in ids]
                places = []
                for source, size in zip(sources, counts, strict=True):
                    places.append(queues.get(source, 0))
                    queues[source] = places[-1] + size
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array([part] * n, pa.int32()), pa.array(range(row, row + n), pa.int64()),
                     pa.array(places, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                    ["doc_id", "source", "part", "row", "queue", "n", "ids"])
                row += n

    schema = f"doc_id {id_type}, source string, part int, row long, queue long, n long, ids binary"
    return docs.select("doc_id", "source", "text").mapInArrow(lambda it: W.released(encode(it)), schema)


def places(at: np.ndarray, mine: int, totals: list[int], quantum: int) -> np.ndarray:
    """Places in the packed stream of the quanta ``at`` (0, 1, ...) of source ``mine``.

    Quantum k of a source with n tokens is due at (k + 1) / n; equals go by the order of sources.
    """
    n = totals[mine]
    exact = (int(at.max(initial=0)) + 1) * max(totals) < 2**62
    k = (at + 1).astype(np.int64 if exact else object)
    out = k * 0
    for other, m in enumerate(totals):
        if other == mine:
            out = out + (k - 1) * quantum
            continue
        if not m:
            continue
        due = k * m // n if other < mine else (k * m - 1) // n  # quanta of the other that are due before
        whole = -(-m // quantum)
        out = out + np.where(due >= whole, m, due * quantum)
    return out


def cut(first: int, size: int, mine: int, totals: list[int], quantum: int, length: int) -> list[tuple[int, int, int, int]]:
    """(start, length, sequence, offset) of the pieces of ``size`` tokens at place ``first`` of a queue."""
    at = np.arange(first // quantum, (first + size - 1) // quantum + 1)
    lead = np.maximum(at * quantum, first)
    stop = np.minimum((at + 1) * quantum, first + size)
    spot = places(at, mine, totals, quantum) + (lead - at * quantum)
    out: list[tuple[int, int, int, int]] = []
    for a, b, p in zip((lead - first).tolist(), (stop - first).tolist(), spot.tolist(), strict=True):
        while a < b:
            p = int(p)
            step = min(b - a, length - p % length)
            if out and out[-1][2] == p // length and out[-1][3] + out[-1][1] == p % length:
                out[-1] = (out[-1][0], out[-1][1] + step, *out[-1][2:])
            else:
                out.append((a, step, p // length, p % length))
            a, p = a + step, p + step
    return out


class Mixture:
    """The tokens of every source in each window of the stream, when token k of a source with weight w is due at
    (k + 1/2) / w, rounded down to ticks of one token of the stream; equals go by the order of sources.

    A drained source is due no more, so the others go on in proportion to their weights.
    """

    def __init__(self, totals: list[int], weights: list[int], length: int):
        self.length, self.all, self.sum = length, sum(totals), sum(weights)
        last = max((((2 * n - 1) * self.sum) // (2 * w) for n, w in zip(totals, weights, strict=True)), default=0)
        exact = (last + 4) * 2 * max(weights, default=1) < 2**62 and 2 * max(totals, default=1) * self.sum < 2**62
        kind = np.int64 if exact else object
        self.n, self.w, self.last = np.array(totals, kind), np.array(weights, kind), last
        ends = np.sort(np.append(0.0, self.n / self.w * self.sum).astype(float))  # where queues drain, by the tick
        share = (self.w / self.sum).astype(float)
        self.ends, self.done = ends, np.array([np.minimum(self.n.astype(float), share * e).sum() for e in ends])

    def counts(self, tick: np.ndarray) -> np.ndarray:
        """Tokens of each source due up to each tick."""
        odd = ((tick[:, None] + 1) * 2 * self.w - 1) // self.sum
        return np.minimum(np.maximum((odd + 1) // 2, 0), self.n)

    def ranks(self, k: np.ndarray, mine: np.ndarray) -> np.ndarray:
        """Places in the stream of the tokens ``k`` of the sources ``mine``."""
        tick = (2 * k.astype(self.n.dtype) + 1) * self.sum // (2 * self.w[mine])
        source = np.arange(len(self.n))
        before = np.where(source < mine[:, None], self.counts(tick), self.counts(tick - 1))
        return np.where(source == mine[:, None], 0, before).sum(1) + k

    def first(self, place: np.ndarray) -> np.ndarray:
        """Tokens of each source among the first ``place`` tokens of the stream."""
        place, slack = place.astype(self.n.dtype), 2 * len(self.n) + 2
        lo, hi = np.zeros_like(place) - 2, np.zeros_like(place) + self.last + 1
        if self.n.dtype != object:  # the search begins near the place
            low, high = (np.interp(place.astype(float) + side, self.done, self.ends) for side in (-slack, slack))
            low, high = (low * (1 - 2.0**-40)).astype(np.int64) - 4, np.minimum((high * (1 + 2.0**-40)).astype(np.int64) + 4, self.last)
            lo = np.where((low > -2) & (self.counts(low).sum(1) < place), low, lo)
            hi = np.where(self.counts(high).sum(1) >= place, high, hi)
        while (lo + 1 < hi).any():  # fewer than place are due at lo, and not fewer at hi
            middle = (lo + hi) // 2
            enough = self.counts(middle).sum(1) >= place
            lo, hi = np.where(enough, lo, middle), np.where(enough, middle, hi)
        base = self.counts(hi - 1)
        equal = self.counts(hi) - base
        left = (place - base.sum(1))[:, None] - (np.cumsum(equal, 1) - equal)
        return base + np.minimum(np.maximum(left, 0), equal)

    def cut(self, first: np.ndarray, size: np.ndarray, mine: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(row, start, length, sequence, offset) of the pieces of ``size`` tokens at places ``first`` of the queues."""
        begin = self.ranks(first, mine) // self.length
        upto = np.cumsum((self.ranks(first + size - 1, mine) // self.length - begin + 1).astype(np.int64))
        step = max(1, 2**20 // len(self.n))
        for a in range(0, int(upto[-1]) if len(upto) else 0, step):
            at = np.arange(a, min(a + step, int(upto[-1])))
            row = np.searchsorted(upto, at, "right")
            window = (begin[row] + at - np.append(0, upto)[row]).astype(np.int64)
            wanted, back = np.unique(np.append(window, window + 1), return_inverse=True)
            edges = self.first(np.minimum(wanted * self.length, self.all))
            low, high = edges[back[: len(at)]], edges[back[len(at):]]
            of, each = mine[row], np.arange(len(at))
            part = high - low
            before = (np.cumsum(part, 1) - part)[each, of]
            lead = np.maximum(first[row], low[each, of])
            stop = np.minimum(first[row] + size[row], high[each, of])
            held = np.flatnonzero(stop > lead)
            out = (row, lead - first[row], stop - lead, window, before + lead - low[each, of])
            yield tuple(x[held].astype(np.int64) for x in out)


def _weights(shares: dict[str | None, float] | None, names: list[str | None], totals: list[int]) -> list[int]:
    if shares is None:
        return totals
    if missing := [x for x in names if not shares.get(x, 0) > 0]:
        raise ValueError(f"no target share above zero for the sources {missing}")
    if all(float(shares[x]).is_integer() for x in names):
        return [int(shares[x]) for x in names]
    scale = 2**24 / sum(shares[x] for x in names)
    return [max(1, round(shares[x] * scale)) for x in names]


def _wide(ids: pa.Buffer, n: int) -> memoryview:
    """``n`` stored ids as bytes of 32-bit numbers."""
    return memoryview(ids) if len(ids) == 4 * n else memoryview(np.frombuffer(ids, "<u2").astype("<u4")).cast("B")


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.tiktoken", length: int = 1024, quantum: int | None = None, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         shares: dict[str | None, float] | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source.

    Every sequence has each source's share of ``length``, in one part, to within a token or two; what rounding leaves is
    carried on, so up to any sequence a source is within 1 + its share x the number of sources of its target.
    ``shares`` gives target proportions (any positive numbers; a source without one is an error); with None they are
    the sources' shares of all tokens, and all queues end together.  Otherwise, when a queue has drained, the rest goes on
    in proportion to the others' targets, so nothing is left out.  With a ``quantum``, sources are instead served by
    that many tokens at a time, by their shares of all tokens: whenever a quantum ends, no source is more than one
    quantum behind, but a sequence has room for few sources.  All sequences are full but the last, which is padded.  Null and empty texts are just the end id.  A null source is a
    source; repeated rows are packed one by one; other columns are ignored; an empty table has no pieces.  Totals are
    one number per source, and every task holds them; sources are meant to be mixture components (up to some
    thousands), not single documents.
    """
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"),
                       F.col(f"`{text_col}`").alias("text"))
    stored = written(tokenize(slim, tokenizer, end_id), "pack-ids")
    per_part = stored.groupBy("part", "source").agg(F.sum("n").alias("tokens"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = written(per_part.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long"))), "pack-base")
    ranked = base.groupBy("source").agg(F.sum("tokens").alias("tokens")).orderBy(F.col("source").asc_nulls_last()).collect()
    names, totals = {r.source: i for i, r in enumerate(ranked)}, [r.tokens for r in ranked]
    if quantum is not None and shares is not None:
        raise ValueError("quanta are served by the sources' shares of all tokens")
    weights = _weights(shares, list(names), totals)
    id_type = dict(slim.dtypes)["doc_id"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget_encoders()
        mixture = Mixture(totals, weights, length)
        for batch in batches:
            for a, many in _calls(batch.column(2).to_numpy() * 4):
                some = batch.slice(a, many)
                mine, n = np.array([names[x] for x in some.column(1).to_pylist()]), some.column(2).to_numpy()
                first = some.column(3).to_numpy()
                raw = [_wide(x.as_buffer(), size) for x, size in zip(some.column(4), n.tolist(), strict=True)]
                if quantum is None:
                    made = mixture.cut(first, n, mine)
                else:
                    flat = [(i, *piece) for i in range(len(raw))
                            for piece in cut(int(first[i]), int(n[i]), int(mine[i]), totals, quantum, length)]
                    made = [tuple(np.array([int(m[j]) for m in flat], np.int64) for j in range(5))]
                for row, start, size, seq, off in made:
                    sums = [zlib.crc32(raw[i][4 * x: 4 * (x + y)]) for i, x, y in zip(
                        row.tolist(), start.tolist(), size.tolist(), strict=True)]
                    at = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [some.column(0).take(at), pa.array(start), pa.array(size), pa.array(sums, pa.int64()), some.column(2).take(at),
                         pa.array(seq), pa.array(off), some.column(1).take(at)],
                        ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"])

    side = base.select("part", F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("s0"), "base")
    placed = stored.withColumns({"s": F.coalesce("source", F.lit("")), "s0": F.col("source").isNull()}).join(
        side, ["part", "s", "s0"])
    placed = placed.select("doc_id", "source", "n", (F.col("base") + F.col("queue")).alias("first"), "ids")
    return placed.mapInArrow(lambda it: W.released(pieces(it)), PIECE.format(id=id_type))
