"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words: its share by weight, held to a cap of ``max_copies`` times its size,
the excess shared anew by weight (water filling in closed form).  ``floor(target / size)`` whole copies of each
document are certain.  For the rest, a document has an inclusion odds p / (1 - p) and a random odds
u / (1 - u); p is proportional to its importance, and where that would be above 1 the document is certain and the
excess goes to the source's others, so that the expected words are what remains.  u comes from a hash of its id; documents are ranked by random odds divided by inclusion odds and
taken in this order until the source's remaining words are reached.  The cut is found by two levels of word
counts over bins of the rank, so no task sorts a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.store import written

BINS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[float], share: float, max_copies: int = 2) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    Sources take the repeating ``weights`` in the order of their names (bytes, null last).  The level L at which
    ``sum(min(cap, L * weight))`` is the total is found by running sums over the sources in order of cap / weight;
    only this one-row-per-source table passes through a single task.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    s = (sizes.withColumn("w", F.element_at(cycle, (F.row_number().over(named) - 1) % len(weights) + 1))
         .withColumn("cap", F.col("source_size") * float(max_copies)))
    rising = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "w_left": F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)),
        "total": F.sum("source_size").over(everything) * float(share)})
    s = s.withColumn("level", (F.col("total") - F.col("cap_before")) / F.col("w_left"))
    s = s.withColumn("level", F.when(F.col("level") * F.col("w") < F.col("cap"), F.col("level")))
    # the first source below its cap sets the level of all after it
    s = s.withColumn("level", F.first("level", ignorenulls=True).over(
        rising.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return s.select("source", "source_size", F.coalesce(F.col("level") * F.col("w"), F.col("cap")).alias("target"))


def inclusion_rates(base: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` (source, left, rate, top and more) with rates for which the sizes in ``base`` (source, size, weight), each
    times least(1, rate * weight), sum up to what is left of the source.

    Documents with rate * weight of 1 or more are certain and the others' rate rises, until the largest weight among
    these (``top``) stays below.  A round is one aggregate over the sizes; without such documents there is none.
    """
    odds = F.col("rate") * F.col("weight")
    while not plan.where("left > 0 and rate * top > 1 + 1e-12").isEmpty():
        facts = _with_plan(base, plan, ["rate"]).groupBy(F.col("source").alias("s")).agg(
            F.sum(F.when(odds >= 1, F.col("size")).otherwise(0)).alias("certain"),
            F.sum(F.when(odds < 1, F.col("weight") * F.col("size")).otherwise(0.0)).alias("open"),
            F.coalesce(F.max(F.when(odds < 1, F.col("weight"))), F.lit(0.0)).alias("most"))
        plan = written(
            plan.join(facts, F.col("source").eqNullSafe(F.col("s"))).withColumns({
                "rate": F.when(F.col("open") > 0, F.greatest("rate", (F.col("left") - F.col("certain")) / F.col("open")))
                .otherwise(F.col("rate")), "top": F.col("most")}).drop("s", "certain", "open", "most"), "mix-plan")
    return plan


def mix_sources(docs: DataFrame, weights: list[float], share: float = 1.0, max_copies: int = 2,
                importance: Column | None = None, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", carry: list[str] | None = None) -> DataFrame:
    """One row (row, doc_id, source, size, source_size, target, copies, taken) per row of ``docs``; copies is 0 to
    ``max_copies``; ``row`` is a struct of the columns named by ``carry`` (by default the id).

    ``importance`` (a column over ``size``; by default ln(2 + size), so long documents are likelier) sets the
    unequal inclusion odds.  Null texts have size 0 and null sources form one source.  Repeated rows are taken one
    by one.  The taken words of a source miss its target by at most about half a document.  The result depends
    only on ids, sizes, sources and ``seed``; other columns are ignored; an empty table gives an empty result.
    """
    base = written(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                               word_count(F.col(f"`{text_col}`")).alias("size")), "mix-sizes")
    weight = F.log(F.col("size") + 2.0) if importance is None else importance
    base = base.withColumn("weight", weight)
    per_source = base.groupBy("source").agg(F.sum("size").alias("source_size"),
                                            F.sum(F.col("weight") * F.col("size")).alias("weighted"),
                                            F.max("weight").alias("top"))
    targets = source_targets(per_source.select("source", "source_size"), weights, share, max_copies)
    plan = written(
        targets.join(per_source.select(F.col("source").alias("s"), "weighted", "top"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                    .otherwise(0).cast("long"))
        .withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("rate", F.when(F.col("weighted") > 0, F.col("left") / F.col("weighted")).otherwise(0.0)), "mix-plan")
    plan = inclusion_rates(base, plan)

    u = (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    p = F.least(F.greatest(F.col("rate") * F.col("weight"), F.lit(1e-9)), F.lit(1 - 1e-9))
    q = u / (1 - u) * (1 - p) / p
    # the order of q as a number from 0 to 1, spread evenly enough over the bins
    def rank(rows: DataFrame) -> DataFrame:
        rows = _with_plan(rows, plan, ["source_size", "target", "whole", "left", "rate"]).withColumn("rank", q / (1 + q))
        return rows.withColumns({"b1": F.floor(F.col("rank") * BINS).cast("int"),
                                 "b2": F.floor(F.col("rank") * BINS * BINS).cast("long")})

    ranked = rank(base)

    edge1 = _edge(ranked.where("left > 0").groupBy("source", "b1").agg(F.sum("size").alias("n"), F.max("left").alias("left")),
                  "b1", F.lit(0).cast("long"))
    edge1 = written(edge1, "mix-edge1")
    in1 = _with_plan(ranked.where("left > 0"), edge1, ["e_b1", "e_before"]).where("b1 = e_b1")
    edge2 = _edge(in1.groupBy("source", "b2").agg(F.sum("size").alias("n"), F.max("left").alias("left"),
                                                  F.max("e_before").alias("e_before")), "b2", F.col("e_before"))
    edges = written(edge1.select("source", "e_b1").join(
        edge2.select(F.col("source").alias("s"), "e_b2", F.col("e_before").alias("e_before")),
        F.col("source").eqNullSafe(F.col("s"))).drop("s"), "mix-edges")

    if carry:
        base = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{id_col}`").alias("doc_id"),
                           F.col(f"`{source_col}`").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size"))
        ranked = rank(base.withColumn("weight", weight))
    else:
        ranked = ranked.withColumn("row", F.struct(F.col("doc_id").alias(id_col)))
    full = _with_plan(ranked, edges, ["e_b1", "e_b2", "e_before"])
    inner = Window.partitionBy("source").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = full.where("left > 0 and b1 = e_b1 and b2 = e_b2").withColumn("upto", F.col("e_before") + F.sum("size").over(inner))
    # of the document that crosses the target, the nearer of both ends
    last = last.withColumn("more", (F.col("upto") - F.col("size") / 2.0 <= F.col("left")).cast("int"))
    rest = full.where("not (left > 0 and b1 <=> e_b1 and b2 <=> e_b2)").withColumn(
        "more", F.expr("int(coalesce(left > 0 and (b1 < e_b1 or b1 = e_b1 and b2 < e_b2), false))"))
    out = last.drop("upto").unionByName(rest).withColumn("copies", (F.col("whole") + F.col("more")).cast("long"))
    return out.select("row", "doc_id", "source", "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"))


def _edge(bins: DataFrame, bin_col: str, start: Column) -> DataFrame:
    """Per source the bin in which the running words reach what is left, and the words before this bin."""
    run = Window.partitionBy("source").orderBy(bin_col)
    bins = bins.withColumn("upto", start + F.sum("n").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    bins = bins.where("upto >= left or upto is null")
    return bins.groupBy("source").agg(F.min(F.struct(F.col(bin_col), (F.col("upto") - F.col("n")).alias("before"))).alias("m")
                                      ).select("source", F.col(f"m.{bin_col}").alias(f"e_{bin_col}"),
                                               F.col("m.before").alias("e_before"))


def _with_plan(rows: DataFrame, plan: DataFrame, cols: list[str]) -> DataFrame:
    """Joins one row per source; a source may hold most rows, so this side is broadcast when it is small (the
    session's threshold decides) and otherwise AQE splits the large partitions."""
    side = plan.select(F.coalesce(F.col("source"), F.lit("")).alias("k"), F.col("source").isNull().alias("k0"), *cols)
    return rows.withColumns({"k": F.coalesce(F.col("source"), F.lit("")), "k0": F.col("source").isNull()}).join(
        side, ["k", "k0"], "left").drop("k", "k0")
