"""Source divergence audit: how far each source's use of words is from other sources and from its language.

Counting is a token-start pointer sort.  A task lays pointers to all token starts over the Arrow buffer of a shard of
texts and sorts the pointers, not the tokens, by multikey quicksort on eight-byte digits: a slice of pointers is
sorted by the next eight bytes, and only runs that are still equal and not ended go one digit deeper.  Pointers go in
by (language, source) and document and every sort is stable, so each equal run falls into one stretch per source, in
which changes of the document give the document frequency.  Shards send one row per (language, source, token); Spark
combines them before and after the shuffle, so a source or a token that holds a third of all words adds a row per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.store import written
from quire.llm.words import LOWER, NOT_LETTER, Words, chunks
from quire.session import broadcast_if_small

SHARD_BYTES = 6 << 20
SCALE = 1_000_000_000
CELLS = 1 << 20
COUNTED = "lang string, source string, term string, n long, docs long"


def pointer_sort(data: np.ndarray, start: np.ndarray, end: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Sorts the pointers ``order`` (indexes of ``start`` / ``end``) by their tokens, stable and in place; returns
    where, in that order, another token begins.  Tokens hold no zero byte."""
    n = len(order)
    fresh = np.zeros(n, bool)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, ">u8", padded, strides=(1,))
    mask = ~np.uint64(0) << (np.uint64(8) * (np.uint64(8) - np.arange(9, dtype=np.uint64)).clip(0, 7))
    mask[0] = 0
    todo, slice_, depth = np.arange(n), np.zeros(n, np.int64), 0
    while len(todo):
        p = order[todo]
        left = (end[p] - start[p] - depth).clip(0)
        digit = eight[np.minimum(start[p] + depth, len(data))].astype(np.uint64) & mask[np.minimum(left, 8)]
        by = np.lexsort((digit, slice_)) if depth else np.argsort(digit, kind="stable")
        order[todo], digit, left = p[by], digit[by], left[by]
        first = np.ones(len(todo), bool)
        first[1:] = (digit[1:] != digit[:-1]) | (slice_[1:] != slice_[:-1])  # slices keep their places
        fresh[todo[first]] = True
        run = np.cumsum(first) - 1
        deeper = (np.bincount(run, left > 8) > 0) & (np.bincount(run) > 1)
        on = deeper[run]
        todo, slice_, depth = todo[on], run[on], depth + 8
    return fresh


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """The byte ranges as an Arrow column of strings."""
    ends = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=ends[1:])
    at = np.arange(ends[-1]) + np.repeat(start - ends[:-1], size)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(ends), pa.py_buffer(data[at])).cast(pa.string())


def _count_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang, source = (batch.column(i).dictionary_encode() for i in (1, 2))
        code = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        names, group = np.unique(code, return_inverse=True)
        group = group.astype(np.uint16 if len(names) < 1 << 16 else np.int64)
        for row, end, data, offsets in chunks(batch.column(0), SHARD_BYTES):
            words = Words(data, offsets, NOT_LETTER)
            if not len(words.start):
                continue
            data, of = LOWER[data], group[row:end][words.doc]
            order = np.argsort(of, kind="stable")
            new = pointer_sort(data, words.start, words.end, order)
            of, doc = of[order], words.doc[order]
            new[1:] |= of[1:] != of[:-1]
            cuts = np.flatnonzero(new)
            new[1:] |= doc[1:] != doc[:-1]
            first, name = order[cuts], names[of[cuts]]
            yield pa.RecordBatch.from_arrays([
                lang.dictionary.take(pa.array(name // len(source.dictionary))),
                source.dictionary.take(pa.array(name % len(source.dictionary))),
                _gather(data, words.start[first], (words.end - words.start)[first]),
                pa.array(np.diff(np.append(cuts, len(order))), pa.int64()),
                pa.array(np.add.reduceat(new.astype(np.int64), cuts))], ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, min_docs: int = 10, text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """(lang, term, n, docs, sources): the terms in at least ``min_docs`` documents (rows) of their language, with
    their occurrences there, and per source with any an element (source, n)."""
    read = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c)
                         for c in (text_col, lang_col, source_col)])
    by_source = read.mapInArrow(_count_shards, COUNTED).groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return by_source.groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("sources")
    ).where(F.col("docs") >= min_docs)


def share(n: str, total: str, terms: str) -> Column:
    """1 + floor(1e9 * (n + 2) / (total + 2 * terms)), exact in 64 bits: long division in steps of five and four digits."""
    c, d = f"({n} + 2)", f"({total} + 2 * {terms})"
    rest, unit = f"(({c} % {d}) * 100000)", 10_000
    return F.expr(f"1 + ({c} div {d}) * {SCALE} + ({rest} div {d}) * {unit} + (({rest} % {d}) * {unit}) div {d}")


def shares(n: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """As ``share``, on arrays."""
    c, d = n + 2, total + 2 * terms
    whole, rest = np.divmod(c, d)
    high, rest = np.divmod(rest * 100_000, d)
    return 1 + whole * SCALE + high * 10_000 + rest * 10_000 // d


def _pair_sums(groups: dict[str, tuple[list[str], list[int], int]]):
    """Adds up, per language, the divergences of all pairs of its sources over the terms that a task reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {lang: {s: i for i, s in enumerate(names)} for lang, (names, _, _) in groups.items()}
        sums = {}
        for batch in batches:
            code = batch.column(0).dictionary_encode()
            lists = batch.column(1)
            starts, flat = lists.offsets.to_numpy(), lists.values
            sources, n = flat.field("source").dictionary_encode(), flat.field("n").to_numpy()
            for k, lang in enumerate(code.dictionary.to_pylist()):
                names, totals, terms = groups[lang]
                to = np.array([place[lang].get(s, -1) for s in sources.dictionary.to_pylist()], np.int64)
                rows = np.flatnonzero(code.indices.to_numpy() == k)
                add = sums.setdefault(lang, np.zeros((len(names), len(names)), np.int64))
                for a in range(0, len(rows), step := max(1, CELLS // len(names))):
                    some = rows[a: a + step]
                    size = starts[some + 1] - starts[some]
                    at = np.arange(size.sum()) + np.repeat(starts[some] - np.cumsum(size) + size, size)
                    count = np.zeros((len(some), len(names)), np.int64)
                    count[np.repeat(np.arange(len(some)), size), to[sources.indices.to_numpy()[at]]] = n[at]
                    p = shares(count, np.array(totals, np.int64), terms)
                    for i in range(len(names) - 1):
                        one, other = p[:, i: i + 1], p[:, i + 1:]
                        add[i, i + 1:] += ((one - other) ** 2 // (one + other)).sum(axis=0)
        for lang, add in sums.items():
            names = groups[lang][0]
            i, j = np.triu_indices(len(names), 1)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(i), pa.string()), pa.array([names[x] for x in i], pa.string()),
                pa.array([names[x] for x in j], pa.string()), pa.array(add[i, j])], ["lang", "a", "b", "f"])

    return run


def source_divergence(docs: DataFrame, min_docs: int = 10, top: int = 10, text_col: str = "text",
                      lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank), all arithmetic exact.

    Every source of a language gives each kept term the share p = 1 + floor(1e9 * (n + 2) / (N + 2 V)); the
    divergence of two shares is floor((p - q)^2 / (p + q)).  Part ``pair``: the sum over all kept terms against each
    other source of the language (0 if no term is kept).  Part ``term``: the ``top`` terms that a source uses more
    than its language.

    Null texts, languages and sources count as ''; a repeated row is another document; a language without kept terms
    has its pairs only; an empty table gives an empty result; other columns are ignored.  The totals of all (language,
    source) groups are held by the driver and by every task: the result has a row for each pair of them anyway."""
    kept = written(term_counts(docs, min_docs, text_col, lang_col, source_col), "audit-terms", "zstd")
    name = {c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (lang_col, source_col)}
    totals = kept.select("lang", F.inline("sources")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_total"))
    groups = written(
        docs.select(name[lang_col].alias("lang"), name[source_col].alias("source")).distinct()
        .join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "terms", "lang_total"]),
        "audit-groups")
    held: dict[str, tuple[list[str], list[int], int]] = {}
    for r in groups.orderBy("lang", "source").collect():
        names, n, _ = held.setdefault(r.lang, ([], [], r.terms))
        names.append(r.source)
        n.append(r.total)

    sums = kept.select("lang", "sources").mapInArrow(_pair_sums(held), "lang string, a string, b string, f long") \
        .groupBy("lang", "a", "b").agg(F.sum("f").alias("value"))
    both = sums.selectExpr("lang", "a as source", "b as item", "value").unionByName(
        sums.selectExpr("lang", "b as source", "a as item", "value"))
    none = groups.where("terms = 0")
    both = both.unionByName(none.select("lang", "source").join(
        none.selectExpr("lang", "source as item"), "lang").where("source != item").withColumn("value", F.lit(0).cast("long")))

    used = kept.select("lang", "term", F.col("n").alias("lang_n"), F.inline("sources")).join(
        broadcast_if_small(groups), ["lang", "source"])
    terms = (used.withColumns({"p": share("n", "total", "terms"), "q": share("lang_n", "lang_total", "terms")})
             .where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value")))
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    out = [both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", ranked.alias("rank")),
           terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", ranked.alias("rank")).where(F.col("rank") <= top)]
    return out[0].unionByName(out[1])
