"""Interval labels of a reporting hierarchy: whatever stands below a position is one range of labels.

Every position keeps one supervisor (the least; an edge of each cycle is cut), which makes a forest.  The Euler tour of
the forest is a linked list of arcs, down to and up from each position; its rank is found by sparse list ranking: a
hashed sample of arcs are rulers, the other arcs reach the next ruler by pointer jumping, and the rulers, of which
there are about ``RULERS`` however large the forest is, are ranked in one task.  A position's label is the rank of its
down arc; its subtree in the forest is the range ``first``..``last``.

Edges outside the forest (further supervisors, edges cut from cycles) are extra intervals: they lead from a label to
another range.  ``below`` closes the ranges of any number of roots over them in one pass.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import shuffled, stored, stored_counted

RULERS = 200_000  # rows that one task ranks
EXTRAS = 200_000  # extra intervals that every task may hold; beyond them the ranges are closed round by round
SALTS = 64  # parts of a position's children that are put in order apart
SLICES = 1024  # blocks of labels for range joins
BLOCK_ROWS = 100_000  # rows of blocks that are broadcast
RANGES = 32  # ranges that are pushed down to the scan of the labels


@dataclass
class Labels:
    """``nodes`` (id, first, last), stored by label; ``extras`` (at, first, last), stored."""

    nodes: DataFrame
    extras: DataFrame
    n: int
    n_extras: int


# ---------------------------------------------------------------- list ranking

def _is_ruler(c: Column, every: int) -> Column:
    return F.lit(True) if every == 1 else F.pmod(F.xxhash64(c), F.lit(every)) == 0


def _to_rulers(links: DataFrame, every: int, n: int) -> DataFrame:
    """``links`` (id, next, w, least) with ``next`` moved on to the next ruler or the end, ``w`` summed and ``least``
    the least on the way.  What never meets a ruler (on a cycle without one) has gone ``n`` links or more."""
    if every == 1:
        return links
    on = F.col("next").isNotNull() & ~_is_ruler(F.col("next"), every)
    cur, width = stored(links.withColumn("on", on), "links"), 1
    while width <= n and not cur.where("on").isEmpty():
        ahead = cur.selectExpr("id as _id", "next as _next", "w as _w", "least as _least")
        step = cur.join(shuffled(ahead), F.col("on") & (F.col("next") == F.col("_id")), "left")
        cur = step.select("id", F.when(F.col("on"), F.col("_next")).otherwise(F.col("next")).alias("next"),
                          (F.col("w") + F.coalesce("_w", F.lit(0))).alias("w"), F.least("least", "_least").alias("least"))
        cur, width = stored(cur.withColumn("on", on), "links"), width * 2
    return cur


def _ranked(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Weight from each link of one list to its end, itself included."""
    parts = [p for p in parts if len(p)]
    if not parts:
        return
    all_ = pd.concat(parts, ignore_index=True)
    nxt = pd.Index(all_["id"]).get_indexer(all_["next"])
    nxt = np.append(np.where(nxt < 0, len(all_), nxt), len(all_))
    w = np.append(all_["w"].to_numpy(np.int64), 0)
    for _ in range(len(all_).bit_length()):
        w, nxt = w + w[nxt], nxt[nxt]
    yield pd.DataFrame({"id": all_["id"], "w": w[:-1]})


def _cycle_ends(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The least id on each cycle of the links."""
    parts = [p for p in parts if len(p)]
    if not parts:
        return
    all_ = pd.concat(parts, ignore_index=True)
    nxt = pd.Index(all_["id"]).get_indexer(all_["next"])
    ways, n = np.append(np.where(nxt < 0, len(all_), nxt), len(all_)), len(all_)
    at = np.arange(n)
    for _ in range(n.bit_length()):  # after n steps whatever has not ended is on a cycle
        ways = ways[ways]
        at = ways[:n]
    cuts, seen = [], set()
    for start in np.unique(at[at < n]).tolist():
        least = None
        while start not in seen:
            seen.add(start)
            least = min(x for x in (least, all_["least"][start]) if x is not None)
            start = nxt[start]
        cuts += [] if least is None else [least]
    yield pd.DataFrame({"id": cuts}, dtype=object)


def _in_one_task(links: DataFrame, every: int) -> DataFrame:
    """The rulers: all links of a small table, else a sample of about ``RULERS``."""
    return links.coalesce(1) if every == 1 else links.where(_is_ruler(F.col("id"), every)).repartition(1)


def _cuts(forest: DataFrame, n: int, rulers: int) -> DataFrame:
    """One position (id) of each cycle of the links (id, up)."""
    every = max(1, n // rulers)
    links = forest.where("up is not null").selectExpr("id", "up as next", "1L as w", "up as least")
    walked = _to_rulers(links, every, n)
    cuts = _in_one_task(walked, every).select("id", "next", "least").mapInPandas(_cycle_ends, "id string")
    return cuts if every == 1 else cuts.unionByName(walked.where("on and id = least").select("id"))


def _arcs(forest: DataFrame, salts: int) -> DataFrame:
    """The Euler tour: (id, next, w); an arc's id is d or u and the position."""
    part = forest.withColumns({"g": F.coalesce("up", F.lit("")), "salt": F.pmod(F.xxhash64("id"), F.lit(salts))})
    part = part.withColumn("sibling", F.lead("id").over(Window.partitionBy("g", "salt").orderBy("id")))
    ends = part.groupBy("g", "salt").agg(F.min("id").alias("head"), F.max("id").alias("tail"))
    if salts > 1:  # the last child of a part is followed by the first of the next part
        ends = ends.withColumn("after", F.lead("head").over(Window.partitionBy("g").orderBy("salt")))
        part = part.join(shuffled(ends.where("after is not null").selectExpr("tail as id", "after")), "id", "left").withColumn(
            "sibling", F.coalesce("sibling", "after"))
    heads = ends.groupBy("g").agg(F.min_by("head", "salt").alias("head")).withColumnRenamed("g", "id")
    both = part.select("id", "up", "sibling").join(shuffled(heads) if salts > 1 else heads, "id", "left")
    down = F.struct(F.concat(F.lit("d"), "id").alias("id"),
                    F.coalesce(F.concat(F.lit("d"), "head"), F.concat(F.lit("u"), "id")).alias("next"), F.lit(1).cast("long").alias("w"))
    up = F.struct(F.concat(F.lit("u"), "id").alias("id"),
                  F.coalesce(F.concat(F.lit("d"), "sibling"), F.concat(F.lit("u"), "up")).alias("next"), F.lit(0).cast("long").alias("w"))
    return both.select(F.inline(F.array(down, up)))


def label_hierarchy(edges: DataFrame, node_ids: DataFrame, rulers: int = RULERS) -> Labels:
    """Labels of all positions.  ``edges`` must be valid edges (both ends are positions); repeated edges and edges from
    a position to itself change nothing."""
    e = stored(edges.select("parent", "child").where("parent != child").distinct(), "edges")
    ups = node_ids.selectExpr("id", "cast(null as string) as up").unionByName(e.selectExpr("child as id", "parent as up"))
    forest, n = stored_counted(ups.groupBy("id").agg(F.min("up").alias("up")), "forest")
    side = shuffled if n > rulers else lambda df: df
    cut, cuts = stored_counted(_cuts(forest, n, rulers), "cuts")
    if cuts:
        forest = stored(forest.join(side(cut.withColumn("cut", F.lit(True))), "id", "left").select(
            "id", F.when(F.col("cut").isNull(), F.col("up")).alias("up")), "forest")
    arcs = _arcs(forest, SALTS if n > rulers else 1)
    every = max(1, 2 * n // rulers)
    walked = _to_rulers(arcs.withColumn("least", F.lit(None).cast("string")), every, 2 * n)
    ranked = _in_one_task(walked, every).select("id", "next", "w").mapInPandas(_ranked, "id string, w long")
    if every > 1:
        beyond = stored(ranked, "ranks").selectExpr("id as next", "w as _w")
        ranked = walked.where(~_is_ruler(F.col("id"), every)).join(side(beyond), "next", "left").select(
            "id", (F.col("w") + F.coalesce("_w", F.lit(0))).alias("w")).unionByName(beyond.selectExpr("next as id", "_w as w"))
    left = ranked.groupBy(F.substring("id", 2, 1 << 30).alias("id")).agg(
        F.max(F.expr("if(id like 'd%', w, null)")).alias("d"), F.max(F.expr("if(id like 'u%', w, null)")).alias("u"))
    labels = left.selectExpr("id", f"{n} - d as first", f"{n} - u - 1 as last")
    nodes = stored(labels.sort("first") if n > RULERS else labels.coalesce(1).sortWithinPartitions("first"), "labels")
    spare = e.join(side(forest.selectExpr("id as child", "up as parent")), ["child", "parent"], "left_anti")
    top, low = nodes.selectExpr("id as parent", "first as at", "last as until"), nodes.withColumnRenamed("id", "child")
    led = side(spare).join(side(top), "parent").join(side(low), "child").where("not (first between at and until)")
    extras, n_extras = stored_counted(led.select("at", "first", "last"), "extras")
    return Labels(nodes, extras, n, n_extras)


# ---------------------------------------------------------------- ranges below roots

def _maximal(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of a forest without those inside others."""
    out = []
    for a, b in sorted(ranges, key=lambda r: (r[0], -r[1])):
        if not out or a > out[-1][1]:
            out.append((a, b))
    return out


def _closer(extras: pd.DataFrame):
    """Closes the range of each root over the extra intervals, each of which is taken up once per root."""
    at = extras["at"].tolist()
    first, last = extras["first"].tolist(), extras["last"].tolist()

    def close(a: int, b: int) -> list[tuple[int, int]]:
        skip: dict[int, int] = {}

        def unused(i: int) -> int:
            path = []
            while i in skip:
                path.append(i)
                i = skip[i]
            for p in path:
                skip[p] = i
            return i

        ranges, todo = [(a, b)], [(a, b)]
        while todo:
            a, b = todo.pop()
            i = unused(bisect_left(at, a))
            while i < len(at) and at[i] <= b:
                skip[i] = i + 1
                ranges.append((first[i], last[i]))
                todo.append(ranges[-1])
                i = unused(i + 1)
        return _maximal(ranges)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [(root, *r) for root, a, b in zip(part["root"], part["first"], part["last"], strict=True) for r in close(a, b)]
            yield pd.DataFrame(rows, columns=["root", "first", "last"])

    return run


def _sliced(ranges: DataFrame, width: int) -> DataFrame:
    """A row for each block of labels that a range touches."""
    return ranges.withColumn("slice", F.explode(F.sequence(F.expr(f"first div {width}"), F.expr(f"last div {width}"))))


def _joined_rounds(start: DataFrame, extras: DataFrame, width: int) -> DataFrame:
    """Ranges closed over the extra intervals by rounds of range joins; a round takes the intervals that lead out of
    the last round's ranges to labels that the root does not have yet."""
    points = extras.withColumn("slice", F.expr(f"at div {width}")).withColumnsRenamed({"first": "_first", "last": "_last"})
    known = frontier = start
    while not frontier.isEmpty():
        led = _sliced(frontier, width).join(points, "slice").where("at between first and last").select(
            "root", F.col("_first").alias("first"), F.col("_last").alias("last")).distinct()
        have = _sliced(known, width).selectExpr("root", "slice", "first as a", "last as b")
        frontier = stored(led.withColumn("slice", F.expr(f"first div {width}")).join(
            have, ["root", "slice"], "left").groupBy("root", "first", "last").agg(
            F.max(F.expr("coalesce(first between a and b, false)")).alias("had")).where("not had").drop("had"), "frontier")
        known = known.unionByName(frontier)
    return known


def ranges_below(labels: Labels, roots: DataFrame | list[str], max_extras: int = EXTRAS) -> DataFrame:
    """(root, first, last): the ranges of labels of the positions reachable from each root (a list of ids,
    or a column ``root`` of distinct ids); a root that is no position has none.  Ranges of one root may lie inside each other only where
    there are more than ``max_extras`` extra intervals."""
    named = labels.nodes.withColumnRenamed("id", "root")
    start = named.where(F.col("root").isin(roots)) if isinstance(roots, list) else roots.select("root").join(named, "root")
    if not labels.n_extras:
        return start
    if labels.n_extras > max_extras:
        return _joined_rounds(stored(start, "ranges"), labels.extras, max(1, labels.n // SLICES))
    return start.mapInPandas(_closer(labels.extras.toPandas().sort_values("at")), "root string, first long, last long")


def below(labels: Labels, roots: DataFrame | list[str], max_extras: int = EXTRAS) -> DataFrame:
    """(root, id): every position reachable from each root, the root included, each once."""
    width = max(1, labels.n // SLICES)
    blocks = F.expr(f"last div {width} - first div {width} + 1")
    ranges, n_blocks = stored_counted(ranges_below(labels, roots, max_extras), "ranges", blocks)
    if labels.n_extras > max_extras:  # ranges inside others
        inner = _sliced(ranges, width).selectExpr("root", "slice", "first as a", "last as b")
        ranges = ranges.withColumn("slice", F.expr(f"first div {width}")).join(inner, ["root", "slice"], "left").groupBy(
            "root", "first", "last").agg(F.max(F.expr("first between a and b and last <= b and (first, last) != (a, b)")).alias("inside")) \
            .where("not inside").drop("inside")
    if isinstance(roots, list) and len(roots) == 1:  # few ranges of one root: a range scan of the labels
        some = ranges.limit(RANGES + 1).collect()
        if len(some) <= RANGES:
            inside = F.lit(False)
            for r in some:
                inside |= F.col("first").between(r.first, r.last)
            return labels.nodes.where(inside).select(F.lit(roots[0]).alias("root"), "id")
    blocks = _sliced(ranges, width)
    at = labels.nodes.select("id", F.col("first").alias("label"), F.expr(f"first div {width}").alias("slice"))
    return at.join(F.broadcast(blocks) if n_blocks <= BLOCK_ROWS else blocks, "slice").where(
        "label between first and last").select("root", "id")
