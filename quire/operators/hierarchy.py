"""Reporting-line hierarchy: edges, reachability from a root, height under every node, cycle report.

Subtrees are ranges of interval labels; heights are resolved from the leaves up, each edge being dropped when its
child resolves.  A round's tables are written to the session's shared checkpoint folder, so each round plans against a
plain scan and a lost executor costs at most one round.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import trim_id
from quire.operators.labels import below, label_hierarchy
from quire.operators.org import ID, SUPERVISOR
from quire.session import shuffled, stored, stored_counted

TAIL = 200_000  # pending edges that one task finishes


def nodes(df: DataFrame, id_col: str = ID) -> DataFrame:
    """Distinct trimmed, non-blank position ids."""
    return df.select(trim_id(F.col(f"`{id_col}`")).alias("id")).where(F.col("id") != "").distinct()


def build_edges(df: DataFrame, id_col: str = ID, sup_col: str = SUPERVISOR) -> DataFrame:
    """(parent, child) for every row with a non-blank id and supervisor; duplicates kept."""
    return (df.select(trim_id(F.col(f"`{sup_col}`")).alias("parent"), trim_id(F.col(f"`{id_col}`")).alias("child"))
            .where((F.col("child") != "") & (F.col("parent") != "")))


def edge_validity(edges: DataFrame, node_ids: DataFrame) -> DataFrame:
    """Edges whose two ends are positions (two semi joins; multiplicity preserved)."""
    n = shuffled(node_ids.select(F.col("id")))
    return (edges.join(n.withColumnRenamed("id", "child"), "child", "left_semi")
            .join(n.withColumnRenamed("id", "parent"), "parent", "left_semi")
            .select("parent", "child"))


def subtree(edges: DataFrame, node_ids: DataFrame, root: str) -> DataFrame:
    """All positions reachable from ``root`` including itself, each once; unknown root -> empty.

    ``edges`` must be valid edges (both ends are positions).  A range scan of the interval labels (``labels.py``); for
    many roots, label the hierarchy once and use ``labels.below``."""
    return below(label_hierarchy(edges, node_ids), [root]).select("id")


def subtree_rows(raw: DataFrame, reached: DataFrame, filter_col=None, id_col: str = ID) -> DataFrame:
    """Raw rows whose trimmed id is in ``reached`` (semi join), optionally filtered."""
    rows = raw.withColumn("_id", trim_id(F.col(f"`{id_col}`"))).join(
        shuffled(reached.select(F.col("id").alias("_id"))), "_id", "left_semi").drop("_id")
    return rows.where(filter_col) if filter_col is not None else rows


def _peel(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rest of the rounds in one task: rows (id, child, h) are pending edges (child set), or what is known of a
    position: its height (``done``) or the most that its resolved children give it so far."""
    parts = [p for p in parts if len(p)]
    if not parts:
        return
    rows = pd.concat(parts, ignore_index=True)
    edges, known = rows[rows["child"].notna()], rows[rows["child"].isna()]
    best = dict(zip(known["id"], known["h"], strict=True))
    pending, over = Counter(edges["id"]), defaultdict(list)
    for parent, child in zip(edges["id"], edges["child"], strict=True):
        over[child].append(parent)
    ready = known[known["done"]]["id"].tolist()
    out = []
    while ready:
        child = ready.pop()
        for parent in over.pop(child, ()):
            best[parent] = max(best.get(parent, 0), best[child] + 1)
            pending[parent] -= 1
            if not pending[parent]:
                ready.append(parent)
                out.append((parent, best[parent], True))
    out += [(p, best.get(p, -1), False) for p, n in pending.items() if n]
    yield pd.DataFrame(out, columns=["id", "height", "resolved"])


def height_under(edges: DataFrame, node_ids: DataFrame, tail: int = TAIL) -> DataFrame:
    """Longest downward path under every position (leaves 0).

    Positions that can reach a cycle are not resolved: they get 1 + the highest resolved child, or -1 without one.
    Output: ``id``, ``height``, ``resolved``.

    Rounds from the leaves up, over what is pending only.  A round meets the pending edges with the positions that
    the last round resolved; an edge whose child is resolved gives its parent a height and leaves the pending ones, and
    a parent without pending edges is resolved.  Heights a parent has so far and its pending edges are combined by one
    partial aggregate, so a position with very many children adds a row per task.  As soon as ``tail`` edges or fewer
    are pending (deep, thin graphs), one task does the rest."""
    e = edges.select("parent", "child").distinct()
    leaves = node_ids.select("id").distinct().join(e.selectExpr("parent as id"), "id", "left_anti")
    fresh = stored(leaves.selectExpr("id", "0 as h"), "resolved")
    done, best = fresh.selectExpr("id", "h as height", "true as resolved"), None
    e, left = stored_counted(e, "pending")
    while left > tail:
        met = stored(e.join(fresh.withColumnRenamed("id", "child"), "child", "left"), "pending")
        e = met.where("h is null").select("parent", "child")
        news = met.where("h is not null").selectExpr("parent as id", "h + 1 as h", "false as open").unionByName(
            e.selectExpr("parent as id", "cast(null as int) as h", "true as open"))
        if best is not None:
            news = news.unionByName(best.selectExpr("id", "h", "false as open"))
        state = stored(news.groupBy("id").agg(F.max("h").alias("h"), F.max("open").alias("open")), "heights")
        fresh, best = state.where("not open").select("id", "h"), state.where("open").select("id", "h")
        done = done.unionByName(fresh.selectExpr("id", "h as height", "true as resolved"))
        left = e.count()
        if fresh.isEmpty():
            return done.unionByName(best.selectExpr("id", "coalesce(h, -1) as height", "false as resolved"))
    rows = e.selectExpr("parent as id", "child", "cast(null as int) as h", "false as done").unionByName(
        fresh.join(e.selectExpr("child as id"), "id", "left_semi").selectExpr("id", "cast(null as string) as child", "h", "true as done"))
    if best is not None:
        rows = rows.unionByName(best.where("h is not null").selectExpr("id", "cast(null as string) as child", "h", "false as done"))
    rest = rows.repartition(1).mapInPandas(_peel, "id string, height int, resolved boolean")
    return done.unionByName(rest)


def cycle_report(heights: DataFrame) -> DataFrame:
    """Number of positions whose height could not be resolved (they sit on or above a cycle)."""
    return heights.agg(F.count_if(~F.col("resolved")).alias("n_unresolved"),
                       F.count(F.lit(1)).alias("n_positions"))
