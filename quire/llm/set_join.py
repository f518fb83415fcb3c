"""Exact n-gram Jaccard join and its groups of linked documents, by skipping with set relations.

Every text is a set of shingle hashes; texts with the same set are one set from the start.  Sets are sorted by one
order of all shingles: by hash, frequent shingles last and by their frequency (counted over all documents in the low
end of their sets).  Two sets that are similar enough share a shingle in the short prefixes of this order.

- Index lists are skipped by position: a pair is looked at only if the sizes of the sets and the positions of the
  shared shingle in them leave room for the needed overlap.
- A long list belongs to many highly similar sets.  Its first set (the least position, so the least odd shingles)
  is joined with all others; what the others share follows from that set's answers: those that it links are one
  group and are skipped among themselves.  The first set outside that group is the next leader, and only pairs
  across groups that no leader has joined are looked at in the end.
- Pairs are bounded by parity sketches of the sets, then checked on the whole sets.

Lists are cut by hash, long ones are plain rows in joins of two shuffles that Spark splits, and texts are hashed
anew when whole sets are needed, so that only the sets of candidate pairs are ever stored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import words as W
from quire.llm.hash_files import HashFiles, bucket_bits, cut_points, joined, put, rows_in, store_set
from quire.llm.store import partitions, scratch_path, written

FREQUENT = 20  # a shingle that so many sets have in their low end goes last in the order
LONG_LIST = 64  # longer lists are joined by way of their first set
FLUSH = 500_000
POSTING = np.dtype([("token", "<u8"), ("key", "<u8"), ("n", "<u4"), ("pos", "<u4")])
CHUNK_BYTES = 1 << 20
PARITY = ["p0", "p1", "p2", "p3"]
SMALL_GRAPH = 200_000  # edges of a graph whose components one task finds
LEADERS = 3  # sets of a long list that are joined with all others before its other pairs are looked at


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``k`` words; linked when ``den`` * intersection >= ``num`` * union."""

    k: int = 5
    num: int = 80
    den: int = 100

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return n - -(-self.num * n // self.den) + 1

    def room(self, n: str, pos: str, m: str, pos2: str) -> str:
        """SQL: whether sets of sizes n and m that first meet at these positions can be similar enough."""
        return f"{self.num + self.den}L * least({n} - {pos}, {m} - {pos2}) >= {self.num}L * ({n} + {m})"

    def near(self, n: str, m: str) -> str:
        """SQL: whether the parity sketches p0 to p3 and q0 to q3 allow it: each odd bit is a shingle of one set."""
        odd = " + ".join(f"bit_count(p{i} ^ q{i})" for i in range(4))
        return f"{self.num + self.den}L * ({n} + {m} - ({odd})) >= {2 * self.num}L * ({n} + {m})"

    def enough(self, shared: np.ndarray, both: np.ndarray) -> np.ndarray:
        return (self.num + self.den) * shared >= self.num * both


def _sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted shingle hashes of all texts in a row, their text, the bounds and sizes of the texts."""
    words = W.Words(data, offsets)
    values, bounds = W.shingle_sets(words, words.hashes(lower=True), k)
    n = np.diff(bounds)
    return values, np.repeat(np.arange(len(n)), n), bounds, n


def _set_keys(values: np.ndarray, bounds: np.ndarray, n: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(values ^ np.uint64(0xA0761D6478BD642F)), dtype=np.uint64)])
    return W.mix(total[bounds[1:]] - total[bounds[:-1]] + n.astype(np.uint64))


def _sketches(values: np.ndarray, doc: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Parity of the shingles per low hash bits: 128 to 8192 bits, about half the size of the set."""
    bits = np.clip(1 << np.ceil(np.log2(np.maximum(n, 2) / 2)).astype(np.int64), 128, 8192)
    lead = np.concatenate([[0], np.cumsum(bits)])
    at = lead[doc] + (values & (bits[doc] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.packbits((np.bincount(at, minlength=lead[-1]) & 1).astype(np.uint8), bitorder="little").tobytes()
    return [odd[a // 8: b // 8] for a, b in zip(lead[:-1].tolist(), lead[1:].tolist(), strict=True)]


def _parity(values: np.ndarray, doc: np.ndarray, texts: int) -> list[pa.Array]:
    """Parity of the shingles per low hash byte, as four numbers of 64 bits per text."""
    odd = np.bincount(doc * 256 + (values & np.uint64(255)).astype(np.int64), minlength=texts * 256).reshape(texts, 256) & 1
    return [pa.array(c) for c in np.ascontiguousarray(np.packbits(odd.astype(np.uint8), 1)).view("<i8").reshape(texts, 4).T.copy()]


def _folded(sketch: bytes, size: int) -> int:
    """The sketch of fewer bits that the same set has."""
    value, have = int.from_bytes(sketch, "little"), len(sketch)
    while have > size:
        have //= 2
        value = (value >> (8 * have)) ^ (value & ((1 << (8 * have)) - 1))
    return value


def _leading(tokens: np.ndarray, bits: int) -> np.ndarray:
    """The leading bits by which shingles are counted: those of the bucket and 32 more.  Shingles that agree in them are
    counted as one, which changes the order of shingles alike for all sets and no result."""
    return tokens >> np.uint64(32 - bits) << np.uint64(32 - bits)


def _planes(rows: np.ndarray) -> bytes:
    """First bytes of all rows, second bytes and so on: sizes, positions and sorted shingles have long runs of equal bytes."""
    return np.ascontiguousarray(rows.view(np.uint8).reshape(len(rows), -1).T).tobytes()


def _rows(cells: pa.ChunkedArray, dtype: np.dtype) -> np.ndarray:
    """The rows of all cells made by ``_planes``."""
    parts = [np.frombuffer(x.as_buffer(), np.uint8).reshape(dtype.itemsize, -1) for x in cells]
    return np.concatenate([np.zeros(0, dtype), *[np.ascontiguousarray(x.T).view(dtype).ravel() for x in parts]])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _scan(batches: Iterator[pa.RecordBatch], sim: Similarity, bits: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """A row for each document, and rows with the sorted low-end shingles of many documents for each bucket."""
    low: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        tokens, counts = np.unique(_leading(np.concatenate(low), bits), return_counts=True)
        low.clear()
        cuts = cut_points(tokens, bits)
        tokens = (tokens >> np.uint64(32 - bits)).astype("<u4")  # the bucket has the bits before them
        full = [i for i in range(1 << bits) if cuts[i] < cuts[i + 1]]
        none = pa.nulls(len(full))
        return pa.RecordBatch.from_arrays(
            [none.cast(id_type), none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.binary()),
             pa.array(full, pa.int32()), pa.array([tokens[cuts[i]: cuts[i + 1]].tobytes() for i in full], pa.binary()),
             pa.array([counts[cuts[i]: cuts[i + 1]].astype("<u4").tobytes() for i in full], pa.binary()),
             *[none.cast(pa.int64())] * 4], names)

    id_type = pa.int64()
    for batch in batches:
        id_type = batch.column(0).type
        for a, b, data, offsets in W.chunks(batch.column(1), CHUNK_BYTES):
            values, doc, bounds, n = _sets(data, offsets, sim.k)
            keys = _set_keys(values, bounds, n)
            first = np.zeros(b - a, bool)
            first[np.unique(keys, return_index=True)[1]] = True
            place = np.arange(len(values)) - bounds[:-1][doc]
            low.append(values[(place < 2 * sim.prefix(n)[doc] + 8) & first[doc]])
            none = pa.nulls(b - a)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(n), _signed(keys), batch.column(2).slice(a, b - a),
                 pa.array(_sketches(values, doc, n), pa.binary()), none.cast(pa.int32()), none.cast(pa.binary()),
                 none.cast(pa.binary()), *_parity(values, doc, b - a)], names)
            if sum(map(len, low)) >= FLUSH:
                yield flush()
    if low:
        yield flush()


def _frequent(table: pa.Table, uri: str, bits: int) -> pa.Table:
    bucket = table["bucket"][0].as_py()
    tokens, counts = joined(table["tokens"], "<u4").astype("<u8"), joined(table["counts"], "<u4")
    tokens = (tokens << np.uint64(32 - bits)) | (np.uint64(bucket) << np.uint64(64 - bits))
    tokens, back = np.unique(tokens, return_inverse=True)
    total = np.bincount(back, counts)
    often = total >= FREQUENT
    put(uri, f"f-{bucket}-k", tokens[often])
    put(uri, f"f-{bucket}-v", np.minimum(total[often], 2**32 - 1).astype("<u4"))
    return pa.table({"n": pa.array([int(often.sum())], pa.int64())})


def _postings(batches: Iterator[pa.RecordBatch], sim: Similarity, uri: str, bits: int) -> Iterator[pa.RecordBatch]:
    """Prefixes: packed by bucket of the shingle, but for frequent shingles, which are plain rows."""
    files = HashFiles(uri, bits)
    names = ["bucket", "packed", "token", "key", "n", "pos"]
    parts: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        rows = np.concatenate(parts)
        parts.clear()
        rows = rows[np.argsort(rows["token"], kind="stable")]
        cuts = cut_points(np.ascontiguousarray(rows["token"]), bits)
        full = [i for i in range(1 << bits) if cuts[i] < cuts[i + 1]]
        none = pa.nulls(len(full))
        return pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array([_planes(rows[cuts[i]: cuts[i + 1]]) for i in full], pa.binary()),
             *[none.cast(pa.int64())] * 4], names)

    for batch in batches:
        for _, _, data, offsets in W.chunks(batch.column(0), CHUNK_BYTES):
            values, doc, bounds, n = _sets(data, offsets, sim.k)
            keys = _set_keys(values, bounds, n)
            first = np.zeros(len(n), bool)
            first[np.unique(keys, return_index=True)[1]] = True
            wanted, back = np.unique(_leading(values, bits), return_inverse=True)
            often = files.look(wanted, "f", "k", {"v": ("<u4", 0)})[0][back]
            order = np.lexsort((values, often, doc))
            place = np.arange(len(values)) - bounds[:-1][doc]  # doc is ascending either way
            order, place = order[(m := (place < sim.prefix(n)[doc]) & first[doc])], place[m]
            rows = np.empty(len(order), POSTING)
            of = doc[order]
            rows["token"], rows["key"], rows["n"], rows["pos"] = values[order], keys[of], n[of], place
            hot = often[order] > 0
            parts.append(rows[~hot])
            if hot.any():
                h = rows[hot]
                none = pa.nulls(len(h))
                yield pa.RecordBatch.from_arrays(
                    [none.cast(pa.int32()), none.cast(pa.binary()), _signed(h["token"]), _signed(h["key"]),
                     pa.array(h["n"].astype(np.int64)), pa.array(h["pos"].astype(np.int64))], names)
            if sum(map(len, parts)) >= FLUSH:
                yield flush()
    if parts:
        yield flush()


def _short_lists(table: pa.Table, sim: Similarity) -> pa.Table:
    """Pairs of the short lists of a bucket that size and position allow; the rows of long lists."""
    rows = _rows(table["packed"], POSTING)
    rows = rows[np.lexsort((rows["key"], rows["token"]))]
    if len(rows):
        rows = rows[np.append(True, (rows["token"][1:] != rows["token"][:-1]) | (rows["key"][1:] != rows["key"][:-1]))]
    _, at, size = np.unique(rows["token"], return_index=True, return_counts=True)
    length = np.repeat(size, size)
    long = rows[length > LONG_LIST]
    rows = rows[(length > 1) & (length <= LONG_LIST)]
    n, pos = rows["n"].astype(np.int64), rows["pos"].astype(np.int64)
    found = [np.zeros((0, 2), np.uint64)]
    for lag in range(1, min(LONG_LIST, len(rows))):
        i = np.flatnonzero(rows["token"][lag:] == rows["token"][:-lag])
        if not len(i):
            break
        j = i + lag
        ok = sim.enough(np.minimum(n[i] - pos[i], n[j] - pos[j]), n[i] + n[j])
        found.append(np.stack([rows["key"][i[ok]], rows["key"][j[ok]]], 1))
    pairs = np.unique(np.concatenate(found), axis=0)
    a, b = pa.nulls(len(pairs)).cast(pa.int64()), pa.nulls(len(long)).cast(pa.int64())
    join = lambda x, y: pa.chunked_array([x, y])
    return pa.table({"a": join(_signed(pairs[:, 0]), b), "b": join(_signed(pairs[:, 1]), b),
                     "token": join(a, _signed(long["token"])), "key": join(a, _signed(long["key"])),
                     "n": join(a, pa.array(long["n"].astype(np.int64))), "pos": join(a, pa.array(long["pos"].astype(np.int64)))})


def _components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, comp) of the edges of one small graph, by hooking roots to lesser ones."""
    ends = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in batches]
    if not ends:
        return
    keys, at = np.unique(np.concatenate(ends, axis=1), return_inverse=True)
    u, v = at.reshape(2, -1)
    comp = np.arange(len(keys))
    while (comp[u] != comp[v]).any():
        low = np.minimum(comp[u], comp[v])
        for roots in (comp[u], comp[v]):
            np.minimum.at(comp, roots, low)
        while (comp[comp] != comp).any():
            comp = comp[comp]
    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(keys[comp])], ["key", "comp"])


def connected(links: DataFrame) -> DataFrame:
    """(key, comp): the least key that each linked key reaches; by alternating large and small stars, until the edges
    that are left are few enough for one task."""
    edges = written(links.selectExpr("least(a, b) as lo", "greatest(a, b) as hi").where("lo <> hi").distinct(), "links")
    while True:
        if edges.count() <= SMALL_GRAPH:
            return written(edges.coalesce(1).mapInArrow(_components, "key long, comp long"), "comps")
        # large star: every larger neighbour of a key goes to the key's least neighbour
        both = edges.selectExpr("lo as u", "hi as v").unionByName(edges.selectExpr("hi as u", "lo as v"))
        least = written(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "star-least")
        large = both.where("v > u").join(least, "u").selectExpr("m as lo", "v as hi").where("lo <> hi").distinct()
        large = written(large, "star-large")
        # small star: every key and its smaller neighbours go to the least of them
        least = written(large.groupBy("hi").agg(F.min("lo").alias("m")), "star-least")
        small = large.join(least, "hi").selectExpr("m as lo", "lo as hi").where("lo <> hi").unionByName(
            least.selectExpr("m as lo", "hi"))
        small = written(small.distinct(), "star-small")
        # settled: every key has one edge, to a key that has none itself
        many = small.groupBy("hi").count().where("count > 1")
        chain = small.join(small.selectExpr("hi as lo").distinct(), "lo", "left_semi")
        edges = small
        if many.isEmpty() and chain.isEmpty():
            break
    roots = edges.select("lo").distinct().selectExpr("lo as key", "lo as comp")
    return written(edges.selectExpr("hi as key", "lo as comp").unionByName(roots), "comps")


class _Join:
    """The steps of one join over one table of documents."""

    def __init__(self, docs: DataFrame, sim: Similarity):
        self.docs, self.sim, self.spark = docs, sim, docs.sparkSession
        self.bits = bucket_bits(partitions(self.spark))
        self.uri = scratch_path(self.spark, "sets")
        sim_, bits = sim, self.bits
        names = ["doc_id", "n", "key", "th", "sketch", "bucket", "tokens", "counts", *PARITY]
        schema = (f"doc_id {docs.dtypes[0][1]}, n long, key long, th long, sketch binary, bucket int, tokens binary, "
                  "counts binary, " + ", ".join(f"{p} long" for p in PARITY))
        self.scan = written(docs.mapInArrow(lambda it: W.released(_scan(it, sim_, bits, names)), schema), "sets-scan")
        self.rows = self.scan.where("bucket is null")
        sizes = self.rows.where("n > 0").groupBy("key").agg(
            F.min("doc_id").alias("first"), F.max("n").alias("n"), F.min(F.struct("th", "sketch", *PARITY)).alias("s"))
        self.reps = written(sizes.select("key", "first", "n", "s.th", "s.sketch", *[f"s.{p}" for p in PARITY]), "sets-reps")

    def lists(self) -> tuple[DataFrame, DataFrame]:
        """Candidate pairs (a, b) of the short lists, and the rows (token, key, n, pos) of the long ones."""
        sim, uri, bits = self.sim, self.uri, self.bits
        self.scan.where("bucket is not null").select("bucket", "tokens", "counts").groupBy("bucket").applyInArrow(
            lambda t: _frequent(t, uri, bits), "n long").agg(F.sum("n")).collect()
        posts = written(self.docs.select("text").mapInArrow(
            lambda it: W.released(_postings(it, sim, uri, bits)), "bucket int, packed binary, token long, key long, n long, pos long"), "sets-posts")
        short = written(posts.where("bucket is not null").select("bucket", "packed").groupBy("bucket").applyInArrow(
            lambda t: _short_lists(t, sim), "a long, b long, token long, key long, n long, pos long"), "sets-lists")
        cols = ["token", "key", "n", "pos"]
        hot = posts.where("bucket is null").select(*cols).unionByName(short.where("a is null").select(*cols))
        return short.where("a is not null").select("a", "b"), written(hot.distinct(), "sets-hot")

    def verify(self, pairs: DataFrame) -> DataFrame:
        """Those of the distinct ``pairs`` that are similar enough."""
        sim, uri, bits = self.sim, scratch_path(self.spark, "wanted"), self.bits
        side = lambda c: self.reps.selectExpr(f"key as {c}", f"n as n{c}", f"sketch as s{c}", f"th as t{c}")
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        both = both.where(f"{sim.den} * least(na, nb) >= {sim.num} * greatest(na, nb)")

        def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
                odd = np.zeros(len(n), np.int64)
                for i, (x, y) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                    size = min(len(x), len(y))
                    odd[i] = (_folded(x, size) ^ _folded(y, size)).bit_count()
                # a bit that differs stands for at least one shingle of only one set
                ok = pa.array(sim.enough((n + m - odd) // 2, n + m))
                yield pa.RecordBatch.from_arrays([batch.column(j).filter(ok) for j in (0, 1, 2, 3, 6, 7)], ["a", "b", "na", "nb", "ta", "tb"])

        left = written(both.select("a", "b", "na", "nb", "sa", "sb", "ta", "tb").mapInArrow(
            lambda it: W.released(bounded(it)), "a long, b long, na long, nb long, ta long, tb long"), "sets-left")
        wanted = left.selectExpr("ta as th", "a as key").unionByName(left.selectExpr("tb as th", "b as key")).distinct()
        wanted = wanted.withColumn("bucket", F.shiftrightunsigned("th", 64 - bits).cast("int"))

        def note(table: pa.Table) -> pa.Table:
            th = table["th"].to_numpy().view(np.uint64)
            order = np.argsort(th)
            bucket = table["bucket"][0].as_py()
            put(uri, f"w-{bucket}-k", th[order])
            put(uri, f"w-{bucket}-v", table["key"].to_numpy()[order])
            return pa.table({"n": pa.array([len(th)], pa.int64())})

        wanted.groupBy("bucket").applyInArrow(note, "n long").agg(F.sum("n")).collect()

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            files, done = HashFiles(uri, bits), set()
            for batch in batches:
                for a, b, data, offsets in W.chunks(batch.column(0), CHUNK_BYTES):
                    th, at = np.unique(batch.column(1).slice(a, b - a).to_numpy().view(np.uint64), return_index=True)
                    key, hit = files.look(th, "w", "k", {"v": ("<i8", 0)})
                    take = [i for i in np.flatnonzero(hit).tolist() if int(key[i]) not in done]
                    if take:
                        done.update(int(key[i]) for i in take)
                        some = batch.column(0).slice(a, b - a).take(pa.array(at[take]))
                        values, _, bounds, _ = _sets(*W.text_bytes(some), sim.k)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(key[take]), pa.array([values[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())],
                            ["key", "shingles"])

        sets = self.docs.select("text", "th").mapInArrow(lambda it: W.released(whole(it)), "key long, shingles binary")
        sets = written(sets.groupBy("key").agg(F.min("shingles").alias("shingles")), "sets-once")

        def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ok = []
                for x, y in zip(batch.column(2), batch.column(3), strict=True):
                    p, q = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                    ok.append(bool(sim.enough(len(np.intersect1d(p, q, True)), len(p) + len(q))))
                yield pa.RecordBatch.from_arrays([batch.column(j).filter(pa.array(ok, pa.bool_())) for j in (0, 1)], ["a", "b"])

        text = lambda c: sets.selectExpr(f"key as {c}", f"shingles as x{c}")
        return written(left.select("a", "b").join(text("a"), "a").join(text("b"), "b").select("a", "b", "xa", "xb")
                       .mapInArrow(lambda it: W.released(linked(it)), "a long, b long"), "sets-links")


_AS_SECOND = {"key": "key2", "n": "n2", "pos": "pos2", "comp": "comp2", **{p: p.replace("p", "q") for p in PARITY}}


def _open_lists(hot: DataFrame, comps: DataFrame, led: DataFrame | None) -> DataFrame:
    """The rows of the long lists that are not all in one group, with their group ``comp`` and whether a leader of
    their list is in it."""
    rows = written(hot.join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key")), "sets-open")
    split = rows.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("token")
    rows = rows.join(split, "token", "left_semi")
    if led is None:
        return written(rows.withColumn("led", F.lit(False)), "sets-rows")
    groups = rows.join(led, ["token", "key"]).select("token", "comp").distinct().withColumn("led", F.lit(True))
    return written(rows.join(groups, ["token", "comp"], "left").withColumn("led", F.coalesce("led", F.lit(False))), "sets-rows")


def _pairs(rows: DataFrame, others: DataFrame, sim: Similarity, across: str) -> DataFrame:
    """Distinct pairs (a, b) of the lists that groups, sizes, positions and sketches allow."""
    near = F.expr(f"{across} and {sim.room('n', 'pos', 'n2', 'pos2')} and {sim.near('n', 'n2')}")
    return rows.join(others, "token").where(near).selectExpr("least(key, key2) as a", "greatest(key, key2) as b").distinct()


def drop_similar(docs: DataFrame, sim: Similarity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of linked ones: the one with the least id.

    Rows that equal it in id and text all stay (exact copies are for exact deduplication), as do texts without
    shingles.  Rows are dropped where they are read, by a 64-bit hash of id and text.
    """
    groups = similar_groups(docs, sim, id_col, text_col).where("not (doc_id <=> component_id)")
    gone = store_set(groups.select(F.xxhash64("doc_id", "th").alias("h")).distinct(), "similar")
    th = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    return rows_in(docs, F.xxhash64(F.col(f"`{id_col}`"), th), gone, False)


def similar_groups(docs: DataFrame, sim: Similarity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc_id, n_shingles, component_id, th) per row of ``docs``; the component is named by the least id
    reachable by links, th is a hash of the text.

    Null and empty texts and texts without words have no shingles, are linked with nothing and keep their own id.
    Texts with the same set are linked.  A null id is never a component's id unless all its ids are null.  Repeated
    rows stay; other columns are ignored; an empty table gives an empty result.
    """
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                       F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("th"))
    join = _Join(slim, sim)
    short, hot = join.lists()
    tried = written(short.distinct(), "sets-tried")
    links = join.verify(tried)
    comps = connected(links)
    hot = written(hot.join(join.reps.select("key", *PARITY), "key"), "sets-hot")
    led = None  # (token, key) of the leaders so far
    for _ in range(LEADERS):
        rows = _open_lists(hot, comps, led)
        lead = written(rows.where("not led").groupBy("token").agg(F.min(F.struct("pos", "n", "key", "comp", *PARITY)).alias("l")).select(
            "token", *[F.col(f"l.{c}").alias(d) for c, d in _AS_SECOND.items()]), "sets-lead")
        star = _pairs(rows, lead, sim, "comp <> comp2").join(tried, ["a", "b"], "left_anti")
        star = written(star, "sets-star")
        led = lead.selectExpr("token", "key2 as key") if led is None else led.unionByName(lead.selectExpr("token", "key2 as key"))
        if star.isEmpty():
            break
        tried = tried.unionByName(star)
        links = links.unionByName(join.verify(star))
        comps = connected(links)
    rows = _open_lists(hot, comps, None)
    other = rows.select("token", *[F.col(c).alias(d) for c, d in _AS_SECOND.items()])
    across = written(_pairs(rows, other, sim, "comp < comp2").join(tried, ["a", "b"], "left_anti"), "sets-across")
    if not across.isEmpty():
        comps = connected(links.unionByName(join.verify(across)))
    named = join.reps.select("key", "first").join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    least = named.groupBy("comp").agg(F.min("first").alias("component_id"))
    named = written(named.select("key", "comp").join(written(least, "sets-least"), "comp").select("key", "component_id"), "sets-named")
    rows = join.rows.select("doc_id", "n", "key", "th")
    out = rows.where("n > 0").join(named, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "th")
    return out.unionByName(rows.where("n = 0").selectExpr("doc_id", "n as n_shingles", "doc_id as component_id", "th"))
