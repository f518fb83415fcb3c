"""Exact duplicates by distributed radix partitioning, most significant bytes first.

Every round splits the groups of texts that still share all bytes read so far by their next bytes (a digit that
widens from round to round) and settles the groups that have become single or whose text has ended.  Equality
comes from the bytes alone; no digest is compared.  Digits are counted with map-side combining, so a group that
holds a large part of all rows adds one row per task; rows meet their digit's count in a join of two plain
shuffles, whose large partitions Spark splits.

Before the first round, texts whose first digit stands alone are settled where they are read: hashes of the
digits that occur twice are put in sorted arrays that every task looks up (a hash that is shared by chance only
sends a text on to the rounds).  So only texts with a common beginning are stored and shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.hash_files import rows_in, store_set
from quire.llm.store import written

FIRST_DIGIT, WIDEN, WIDEST = 512, 16, 1 << 20


def _digit(rest: str, width: int, *lead: str) -> Column:
    return F.struct(*lead, (F.length(rest) <= width).alias("ended"), F.substring(rest, 1, width).alias("bytes"))


def _fields(id_col: str, carry: list[str] | None) -> list[Column]:
    return [F.struct(*[F.col(f"`{c}`") for c in carry or [id_col]]).alias("row"), F.col(f"`{id_col}`").alias("doc_id")]


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row (row, doc_id, keep_id, group_size, kept, text_sha256) per row of ``docs``; ``row`` is a struct of the
    columns named by ``carry`` (by default none: it has the id).

    Null texts count as empty; texts are equal when their UTF-8 bytes are.  The row with the largest id of a group
    stays (a null id is the smallest); of repeated rows with that id exactly one stays.  Other columns are ignored;
    an empty table gives an empty result.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    read = docs.select(*_fields(id_col, carry), F.sha2(text, 256).alias("sha"), F.encode(text, "UTF-8").alias("rest"))
    h = F.xxhash64(_digit("rest", FIRST_DIGIT))
    twice = store_set(read.select(h.alias("h")).groupBy("h").count().where("count > 1"), "digits")
    # the hash needs no more of a text than this, and the settled rows no more than the hash
    begin = F.encode(F.substring(text, 1, FIRST_DIGIT + 1), "UTF-8")
    lone = docs.select(*_fields(id_col, carry), F.sha2(text, 256).alias("sha"), begin.alias("rest"))
    settled = rows_in(lone, h, twice, False).selectExpr(
        "row", "doc_id", "doc_id as keep_id", "1L as group_size", "true as kept", "sha as text_sha256")
    rows = written(rows_in(read, h, twice, True).select(  # fixes the row numbers
        F.monotonically_increasing_id().alias("nr"), "row", "doc_id", "sha", F.lit(0).cast("long").alias("grp"), "rest"), "radix")
    width = FIRST_DIGIT
    while True:
        split = rows.withColumn("digit", _digit("rest", width, "grp"))
        shared = written(split.groupBy("digit").agg(
            F.count("*").alias("n"), F.max(F.struct("doc_id", "nr")).alias("top"), F.min("nr").alias("next"))
            .where("n > 1"), "radix-shared")
        on = F.expr("n > 1 and not digit.ended")
        step = written(split.join(shared, "digit", "left").select(
            "nr", "row", "doc_id", "sha", F.expr("if(n is null, doc_id, top.doc_id)").alias("keep_id"),
            F.expr("coalesce(n, 1L)").alias("group_size"), F.expr("coalesce(nr = top.nr, true)").alias("kept"),
            F.when(on, F.col("next")).alias("grp"),
            F.when(on, F.expr(f"substring(rest, {width + 1})")).alias("rest")), "radix-step")
        settled = settled.unionByName(step.where("rest is null").selectExpr(
            "row", "doc_id", "keep_id", "group_size", "kept", "sha as text_sha256"))
        if shared.where("not digit.ended").isEmpty():
            return settled
        rows = step.where("rest is not null").select("nr", "row", "doc_id", "sha", "grp", "rest")
        width = min(width * WIDEN, WIDEST)
