"""Result-table operators of the two-pass document flow: ledgers, appends, upserts, parent/child context,
review ordering and distributions.

Row-order semantics ("first match", "last update wins") are made explicit with a ``seq`` column and
resolved with ``min_by`` / ``max_by`` (decomposable, so hot keys combine map-side).  Ledger lookups are
anti / semi joins; Catalyst / AQE pick broadcast or shuffle by the measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.text import SENTINELS, TEXT_BUDGET, clean_reason, is_sentinel, normalize_status

# Fixed values that must equal the reference: review order of statuses and of priorities, the context
# headings of the second pass.
STATUS_ORDER = ["true", "false", "n/a", "error", ""]
PRIORITY_ORDER = ["high", "medium", "low", ""]
CURRENT_HEAD = "Current Contract Description: "
PARENT_HEAD = "Parent Contract Description: "
CHILD_HEAD = "Child Contract Descriptions:\n"
CHILD_BULLET = "- "


def match_key(key: Column, valid: Column, *spread: str) -> Column:
    """A join key that matches only where ``valid``: other rows get keys of their own, spread by a hash of
    ``spread``, so sentinels and nulls neither match nor meet in one task."""
    return F.when(valid, key).otherwise(F.concat(F.lit("\x00"), F.xxhash64(*spread).cast("string")))


# ---------------------------------------------------------------- ledgers

def unprocessed(files: DataFrame, ledger: DataFrame, key: str = "path", status: str | None = "status") -> DataFrame:
    """Files not in the processed ledger; ledger rows with status ``retry`` do not count as processed."""
    done = ledger.where(~F.col(status).eqNullSafe("retry")) if status and status in ledger.columns else ledger
    return files.join(done.select(key).distinct(), key, "left_anti")


def skip_reviewed(records: DataFrame, reviewed: DataFrame, key: str = "contract_number") -> DataFrame:
    """Drop records whose id is already reviewed; sentinel ids (``Not found`` / ``Error``) always pass."""
    known = reviewed.select(F.col(key).alias("_known")).where(~is_sentinel(key)).distinct()
    own = match_key(F.col(key), F.col(key).isNotNull() & ~is_sentinel(key), *records.columns)
    return records.withColumn("_own", own).join(known, F.col("_own") == F.col("_known"), "left_anti").drop("_own")


def new_ledger_rows(records: DataFrame, ledger: DataFrame, run_date: str, key: str = "contract_number") -> DataFrame:
    """``(key, review_date)`` for ids not yet in the ledger; sentinels, null and '' are never recorded;
    duplicates within the batch are recorded once."""
    ids = records.select(key).where(F.col(key).isNotNull() & (F.col(key) != "") & ~is_sentinel(key)).distinct()
    return (ids.join(ledger.select(key), key, "left_anti")
            .withColumn("review_date", F.lit(run_date)))


def append_ledger(records: DataFrame, ledger: DataFrame, run_date: str, key: str = "contract_number",
                  predicate: Column | None = None) -> DataFrame:
    """Ledger after appending the batch (optionally only records passing ``predicate``)."""
    src = records.where(predicate) if predicate is not None else records
    return ledger.select(key, "review_date").unionByName(new_ledger_rows(src, ledger, run_date, key))


def reviewed_dedupe(ledger: DataFrame, key: str = "contract_number") -> DataFrame:
    return ledger.select(key).distinct()


def known_ids_update(known: DataFrame, new_ids: DataFrame, key: str = "contract_number") -> DataFrame:
    return known.select(key).union(new_ids.select(key)).distinct()


# ---------------------------------------------------------------- appends and defaults

def _default(defaults: dict, f: T.StructField) -> Column:
    d = defaults.get(f.name)
    return (F.array(*[F.lit(x) for x in d]) if isinstance(d, list) else F.lit(d)).cast(f.dataType)


def backfill_columns(df: DataFrame, schema: T.StructType, defaults: dict, fill: tuple[str, ...] = ()) -> DataFrame:
    """Columns in schema order, absent ones with their default.  Present columns keep their nulls, except those
    named by ``fill``, whose nulls take the default too."""
    cols = []
    for f in schema.fields:
        d = _default(defaults, f)
        if f.name in fill and f.name in df.columns:
            cols.append(F.coalesce(F.col(f.name).cast(f.dataType), d).alias(f.name))
        elif f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(d.alias(f.name))
    return df.select(*cols)


def append_results(existing: DataFrame, new: DataFrame, schema: T.StructType, defaults: dict,
                   fill: tuple[str, ...] = ()) -> DataFrame:
    """``UNION ALL`` of old and new rows by column name; a column that one side lacks takes its default there."""
    return backfill_columns(existing, schema, defaults, fill).unionByName(backfill_columns(new, schema, defaults, fill))


# ---------------------------------------------------------------- per-key first / last

def first_per_key(df: DataFrame, key: str, value: str, seq: str = "seq") -> DataFrame:
    return df.groupBy(key).agg(F.min_by(F.col(value), F.col(seq)).alias(value))


def last_per_key(df: DataFrame, key: str, cols: list[str], seq: str) -> DataFrame:
    """Last row per key (by ``seq``) restricted to ``cols``."""
    return (df.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(seq)).alias("_last"))
            .select(key, *[F.col(f"_last.{c}").alias(c) for c in cols]))


def detail_lookup(df: DataFrame, batch: DataFrame, key: str = "contract_number") -> DataFrame:
    """Rows whose id is in the batch (semi join)."""
    return df.join(batch.select(key), key, "left_semi")


# ---------------------------------------------------------------- second pass: answers and upsert

def attach_second_pass(results: DataFrame, answers: DataFrame, key: str = "contract_number",
                       request_key: str = "request_id", seq: str = "aseq", echo: str = "contract_number") -> DataFrame:
    """Route pass-2 answers to rows by the request id (last answer wins; unmatched answers dropped).

    ``key`` is the column of ``results`` that holds the request id, such as the file path; sentinel ids take no
    answer.  Status is lower-cased; an empty / ``nan`` reason becomes the placeholder.  The id echoed in the answer
    is kept as ``echoed_id``."""
    known = answers.where(_not_sentinel(request_key))
    last = last_per_key(known, request_key, ["second_pass_munchable", "second_pass_reason", echo], seq)
    st, rs = normalize_status(F.col("a_status"), F.col("a_reason"))
    joined = results.withColumn("_own", match_key(F.col(key), _not_sentinel(key), *results.columns)).join(
        last.select(F.col(request_key).alias("_own"), F.col("second_pass_munchable").alias("a_status"),
                    F.col("second_pass_reason").alias("a_reason"), F.col(echo).alias("echoed_id"),
                    F.lit(True).alias("_hit")),
        "_own", "left").drop("_own")
    return (joined.withColumn("second_pass_munchable",
                              F.when(F.col("_hit"), st).otherwise(F.col("second_pass_munchable")))
            .withColumn("second_pass_reason", F.when(F.col("_hit"), rs).otherwise(F.col("second_pass_reason")))
            .drop("a_status", "a_reason", "_hit"))


UPSERT_COLUMNS = ["first_pass_munchable", "first_pass_reason", "second_pass_munchable", "second_pass_reason"]


def upsert_results(results: DataFrame, updates: DataFrame, key: str = "contract_number", seq: str = "useq",
                   columns=UPSERT_COLUMNS) -> DataFrame:
    """Overwrite ``columns`` on every row with a matching key by the key's last update; sentinel keys never
    match; reasons are cleaned (null / whole-value ``nan`` -> '').  Row count is unchanged."""
    last = last_per_key(updates.where(~is_sentinel(key) & F.col(key).isNotNull()), key, list(columns), seq)
    u = last.select(F.col(key).alias("_own"), *[F.col(c).alias(f"_u_{c}") for c in columns], F.lit(True).alias("_hit"))
    own = match_key(F.col(key), F.col(key).isNotNull() & ~is_sentinel(key), *results.columns)
    out = results.withColumn("_own", own).join(u, "_own", "left").drop("_own")
    for c in columns:
        out = out.withColumn(c, F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)))
    for c in columns:
        if c.endswith("_reason"):
            out = out.withColumn(c, clean_reason(c))
    return out.drop("_hit", *[f"_u_{c}" for c in columns])


# ---------------------------------------------------------------- context for the second pass

def _not_sentinel(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "") & ~F.col(c).isin(*SENTINELS)


def context_parent(records: DataFrame, key: str = "contract_number", parent: str = "parent_contract_number",
                   desc: str = "description", seq: str = "seq", within: list[str] | None = None) -> DataFrame:
    """``parent_description`` for each record: first record (by ``seq``) numbered like its parent.
    Sentinel parents never match.  ``within`` (e.g. ``["chunk_no"]``) limits the lookup to rows sharing
    those columns, which reproduces the reference's chunk-local context."""
    scope = list(within or [])
    parents = (records.where(_not_sentinel(key)).groupBy(key, *scope)
               .agg(F.min_by(F.col(desc), F.col(seq)).alias("parent_description"))
               .select(F.col(key).alias("_pkey"), *[F.col(c).alias(f"_p_{c}") for c in scope],
                       "parent_description"))
    rows = records.withColumn("_own", match_key(F.col(parent), _not_sentinel(parent), seq))
    cond = rows["_own"] == parents["_pkey"]
    for c in scope:
        cond = cond & (rows[c] == parents[f"_p_{c}"])
    return rows.join(parents, cond, "left").drop("_own", "_pkey", *[f"_p_{c}" for c in scope])


def context_children(records: DataFrame, parent: str = "parent_contract_number", desc: str = "description",
                     seq: str = "seq", within: list[str] | None = None, budget: int = TEXT_BUDGET) -> DataFrame:
    """``(parent, child_block)``: heading plus one ``- description`` line per child in ``seq`` order, cut to
    ``budget`` characters.

    A child is kept while the lines before it leave room in the budget.  The running length is first taken inside
    (parent, task), so a parent with very many children is cut down by all tasks before its rows meet; it is
    never more than the running length over the whole parent, so no line of the block is lost.  ``within`` as in
    ``context_parent``."""
    keys = [parent, *(within or [])]
    line = F.concat(F.lit(CHILD_BULLET), F.coalesce(F.col(desc), F.lit("")), F.lit("\n"))
    kept = (records.where(_not_sentinel(parent)).select(*keys, seq, line.alias("_line"))
            .withColumn("_task", F.spark_partition_id()))
    for scope in ([*keys, "_task"], keys):
        before = Window.partitionBy(*scope).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
        kept = (kept.withColumn("_used", F.coalesce(F.sum(F.length("_line")).over(before), F.lit(0)))
                .where(F.col("_used") < F.lit(budget - len(CHILD_HEAD))))
    lines = F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), F.col("_line").alias("l"))))
    block = F.concat(F.lit(CHILD_HEAD), F.array_join(F.col("_c.l"), ""))
    return (kept.groupBy(*keys).agg(lines.alias("_c"))
            .select(F.col(parent).alias("_ckey"), *[F.col(c).alias(f"_c_{c}") for c in within or []],
                    F.substring(block, 1, budget).alias("child_block")))


def context_text(records: DataFrame, key: str = "contract_number", parent: str = "parent_contract_number",
                 desc: str = "description", seq: str = "seq", budget: int = TEXT_BUDGET,
                 within: list[str] | None = None) -> DataFrame:
    """Second-pass request text per record: current description, parent description if a parent record exists,
    child list if children exist; cut to the text budget.  Context spans the whole table by default;
    ``within=["chunk_no"]`` (with ``chunk_rows``) restricts it to one chunk as the reference does."""
    scope = list(within or [])
    with_parent = context_parent(records, key, parent, desc, seq, scope)
    kids = context_children(records, parent, desc, seq, scope, budget)
    cond = with_parent[key] == kids["_ckey"]
    for c in scope:
        cond = cond & (with_parent[c] == kids[f"_c_{c}"])
    j = with_parent.join(kids, cond, "left").drop("_ckey", *[f"_c_{c}" for c in scope])
    text = F.concat(
        F.lit(CURRENT_HEAD), F.coalesce(F.col(desc), F.lit("")), F.lit("\n\n"),
        F.when(F.col("parent_description").isNotNull(),
               F.concat(F.lit(PARENT_HEAD), F.col("parent_description"), F.lit("\n\n"))).otherwise(F.lit("")),
        F.coalesce(F.col("child_block"), F.lit("")))
    return j.withColumn("context_text", F.substring(text, 1, budget))


def parent_child_verdict(records: DataFrame, verdict: str = "second_pass_munchable", key: str = "contract_number",
                         parent: str = "parent_contract_number", seq: str = "seq") -> DataFrame:
    """A child of a parent whose verdict is ``false`` is ``false``; otherwise its own verdict."""
    pv = (records.where(_not_sentinel(key)).groupBy(key)
          .agg(F.min_by(F.lower(F.col(verdict)), F.col(seq)).alias("_pv")).withColumnRenamed(key, "_pk"))
    j = records.withColumn("_own", match_key(F.col(parent), _not_sentinel(parent), seq)).join(
        pv, F.col("_own") == F.col("_pk"), "left").drop("_own")
    return j.withColumn("final_verdict",
                        F.when(F.col("_pv") == F.lit("false"), F.lit("false")).otherwise(F.lower(F.col(verdict)))
                        ).drop("_pk", "_pv")


# ---------------------------------------------------------------- chunks, ordering, samples

def chunk_rows(df: DataFrame, size: int, seq: str = "seq") -> DataFrame:
    """``chunk_no`` = (position in ``seq`` order) div ``size``, without a global single-partition window.

    A range-partitioned sort, then ``monotonically_increasing_id`` (partition id in the high bits, row number
    in the partition in the low bits) on the checkpointed sorted table; per-partition counts give each
    partition's offset (a table with one row per partition, so its broadcast is bounded)."""
    from quire.session import cut_lineage

    t = cut_lineage(df.orderBy(F.col(seq)).withColumn("_mid", F.monotonically_increasing_id()))
    t = t.withColumn("_pid", F.shiftright("_mid", 33)).withColumn("_loc", F.col("_mid").bitwiseAND((1 << 33) - 1))
    counts = t.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    return (t.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
            .withColumn("chunk_no", F.call_function("div", F.col("_off") + F.col("_loc"), F.lit(size)))
            .drop("_mid", "_pid", "_loc", "_off"))


def rank_of(c: Column, order: list[str]) -> Column:
    expr = None
    for i, v in enumerate(order):
        expr = F.when(c == F.lit(v), F.lit(i)) if expr is None else expr.when(c == F.lit(v), F.lit(i))
    return expr  # unmapped -> null, sorted last


def order_by_status(df: DataFrame, status: str = "second_pass_munchable", seq: str = "seq") -> DataFrame:
    """Review order ``true < false < n/a < error < ''``, unmapped last, then ``seq``."""
    out = df.withColumn("status_rank", rank_of(F.lower(F.col(status)), STATUS_ORDER))
    return out.orderBy(F.col("status_rank").asc_nulls_last(), F.col(seq))


def order_by_priority(df: DataFrame, priority: str = "priority_level", score: str = "second_pass_score",
                      seq: str = "seq") -> DataFrame:
    """``high < medium < low < ''``, unmapped last, then score descending."""
    out = df.withColumn("priority_rank", rank_of(F.lower(F.col(priority)), PRIORITY_ORDER))
    return out.orderBy(F.col("priority_rank").asc_nulls_last(), F.col(score).desc_nulls_last(), F.col(seq))


def sample_first_n(df: DataFrame, n: int = 3, seq: str = "seq") -> DataFrame:
    """First ``n`` rows in ``seq`` order (test mode)."""
    return df.orderBy(F.col(seq)).limit(n)


# ---------------------------------------------------------------- distributions

def status_distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    """Value counts per column, nulls dropped, long form ``(column, status, n)``, most frequent first; one pass."""
    return (df.select(*columns).unpivot([], columns, "column", "status").where(F.col("status").isNotNull())
            .groupBy("column", "status").agg(F.count(F.lit(1)).alias("n"))
            .orderBy("column", F.col("n").desc(), "status"))


def flag_counts(df: DataFrame, flags: list[str]) -> DataFrame:
    """Rows with each flag true, one pass, long form ``(flag, n)``."""
    wide = df.agg(*[F.count_if(F.col(f)).alias(f) for f in flags])
    stack = ", ".join(f"'{f}', `{f}`" for f in flags)
    return wide.selectExpr(f"stack({len(flags)}, {stack}) as (flag, n)")
