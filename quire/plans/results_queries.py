"""Result-table queries: ledgers, appends, upserts, second-pass context, ordering, distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire import schemas
from quire.functions.text import clean_reason, file_stem, normalize_status, path_key, safe_file_name
from quire.operators import results as R
from quire.operators.key_ledger import KeyLedger
from quire.operators.versioned import VersionedTable
from quire.plans import sql_parts as S
from quire.plans.org_queries import scratch
from quire.plans.registry import REGISTRY, query
from quire.sources import tables

RUN_DATE = tables.RUN_DATE
SENT = "('Not found', 'Error')"


def _c(spark, sf):
    return tables.contracts(spark, sf)


@query("unprocessed", S.with_ctes("""
SELECT file_path AS path FROM contracts
WHERE file_path NOT IN (SELECT path FROM processed_log WHERE coalesce(status, '') <> 'retry')""", "processed_log"))
def q_unprocessed(spark, sf):
    files = _c(spark, sf).select(F.col("file_path").alias("path"))
    return R.unprocessed(files, tables.processed_log(spark, sf))


@query("unprocessed_pruned", REGISTRY["unprocessed"].sql,
       note="ledger of three batches, bucketed by key with Bloom filters; only folders that may hold a key are read")
def q_unprocessed_pruned(spark, sf):
    files = _c(spark, sf).select(F.col("file_path").alias("path"))
    ledger, log = KeyLedger(spark, scratch(spark, "key-ledger"), buckets=16), tables.processed_log(spark, sf)
    for batch in range(3):
        ledger.add(log.where(F.pmod(F.xxhash64("path"), F.lit(3)) == batch), batch)
    return ledger.unprocessed(files)


@query("skip_reviewed", S.with_ctes(f"""
SELECT seq, contract_number FROM pass1_records
WHERE contract_number NOT IN (SELECT contract_number FROM reviewed_ledger WHERE contract_number NOT IN {SENT})""",
    "reviewed_ledger"))
def q_skip_reviewed(spark, sf):
    return R.skip_reviewed(tables.pass1_records(spark, sf), tables.reviewed_ledger(spark, sf)).select(
        "seq", "contract_number")


_NEW_IDS = f"""
SELECT DISTINCT contract_number FROM pass1_records
WHERE contract_number IS NOT NULL AND contract_number <> '' AND contract_number NOT IN {SENT}
  AND contract_number NOT IN (SELECT contract_number FROM reviewed_ledger)"""


@query("append_ledger", S.with_ctes(f"""
SELECT contract_number, review_date FROM reviewed_ledger
UNION ALL SELECT contract_number, '{RUN_DATE}' FROM ({_NEW_IDS}) n""", "reviewed_ledger"))
def q_append_ledger(spark, sf):
    return R.append_ledger(tables.pass1_records(spark, sf), tables.reviewed_ledger(spark, sf), RUN_DATE)


@query("reviewed_dedupe", S.with_ctes("SELECT DISTINCT contract_number FROM reviewed_ledger", "reviewed_ledger"))
def q_reviewed_dedupe(spark, sf):
    return R.reviewed_dedupe(tables.reviewed_ledger(spark, sf))


@query("known_ids_update", S.with_ctes(f"""
SELECT contract_number FROM reviewed_ledger UNION SELECT contract_number FROM ({_NEW_IDS}) n""",
    "reviewed_ledger"))
def q_known_ids_update(spark, sf):
    ledger = tables.reviewed_ledger(spark, sf)
    new = R.new_ledger_rows(tables.pass1_records(spark, sf), ledger, RUN_DATE)
    return R.known_ids_update(ledger, new)


def _in_order(src: str) -> str:
    return f"SELECT {', '.join(f.name for f in schemas.CONTRACT_RESULT.fields)} FROM {src}"


_DROPPED = ["first_pass_munchable", "first_pass_reason", "is_idiq"]


@query("backfill_columns", S.with_ctes(_in_order(
    "(SELECT * REPLACE (coalesce(second_pass_reason, '') AS second_pass_reason, '' AS first_pass_munchable, "
    "'' AS first_pass_reason, false AS is_idiq) FROM contracts) t"), "contracts"))
def q_backfill_columns(spark, sf):
    """Absent columns take their default, present ones keep their nulls, but for the reason named to be filled."""
    return R.backfill_columns(_c(spark, sf).drop(*_DROPPED), schemas.CONTRACT_RESULT, schemas.CONTRACT_DEFAULTS,
                              fill=("second_pass_reason",))


@query("append_results", S.with_ctes(_in_order("""
(SELECT * REPLACE ('' AS second_pass_munchable, '' AS second_pass_reason) FROM contracts WHERE seq % 2 = 0
 UNION ALL BY NAME SELECT * FROM contracts WHERE seq % 2 = 1) t"""), "contracts"))
def q_append_results(spark, sf):
    c = _c(spark, sf)
    old = c.where("seq % 2 = 0").drop("second_pass_munchable", "second_pass_reason")
    new = c.where("seq % 2 = 1")
    return R.append_results(old, new, schemas.CONTRACT_RESULT, schemas.CONTRACT_DEFAULTS)


@query("first_per_key", S.with_ctes("""
SELECT parent_contract_number, arg_min_null(description, seq) AS description FROM contracts GROUP BY 1""", "contracts"))
def q_first_per_key(spark, sf):
    return R.first_per_key(_c(spark, sf), "parent_contract_number", "description")


@query("last_per_key", S.with_ctes("""
SELECT request_id, arg_max_null(second_pass_munchable, aseq) AS second_pass_munchable,
       arg_max_null(second_pass_reason, aseq) AS second_pass_reason
FROM pass2_answers GROUP BY 1""", "pass2_answers"))
def q_last_per_key(spark, sf):
    return R.last_per_key(tables.pass2_answers(spark, sf), "request_id",
                          ["second_pass_munchable", "second_pass_reason"], "aseq")


@query("detail_lookup", S.with_ctes("""
SELECT seq, contract_number FROM contracts WHERE contract_number IN (SELECT contract_number FROM pass2_answers)""",
    "pass2_answers"))
def q_detail_lookup(spark, sf):
    return R.detail_lookup(_c(spark, sf), tables.pass2_answers(spark, sf)).select("seq", "contract_number")


_LAST_ANSWER = """
SELECT request_id, arg_max_null(second_pass_munchable, aseq) AS a_status, arg_max_null(second_pass_reason, aseq) AS a_reason,
       arg_max_null(contract_number, aseq) AS echoed_id
FROM pass2_answers GROUP BY 1"""


@query("attach_second_pass", S.with_ctes(f"""
SELECT c.seq, c.contract_number,
       CASE WHEN a.request_id IS NOT NULL THEN lower(a.a_status) ELSE c.second_pass_munchable END
         AS second_pass_munchable,
       CASE WHEN a.request_id IS NULL THEN c.second_pass_reason
            WHEN a.a_reason IS NULL OR a.a_reason IN ('', 'nan') THEN 'No reason provided' ELSE a.a_reason END
         AS second_pass_reason,
       a.echoed_id
FROM contracts c LEFT JOIN ({_LAST_ANSWER}) a ON c.contract_number = a.request_id
  AND c.contract_number NOT IN {SENT} AND c.contract_number <> ''""", "pass2_answers"))
def q_attach_second_pass(spark, sf):
    out = R.attach_second_pass(_c(spark, sf), tables.pass2_answers(spark, sf))
    return out.select("seq", "contract_number", "second_pass_munchable", "second_pass_reason", "echoed_id")


def _status_rank_sql(e: str) -> str:
    return (f"(CASE lower({e}) WHEN 'true' THEN 0 WHEN 'false' THEN 1 WHEN 'n/a' THEN 2 WHEN 'error' THEN 3 "
            f"WHEN '' THEN 4 END)")


def _clean_reason_sql(e: str) -> str:
    return f"(CASE WHEN {e} IS NULL OR {e} = 'nan' THEN '' ELSE {e} END)"


@query("upsert_results", S.with_ctes(f"""
SELECT seq, contract_number, first_pass_munchable, {_clean_reason_sql('first_pass_reason')} AS first_pass_reason,
       second_pass_munchable, {_clean_reason_sql('second_pass_reason')} AS second_pass_reason,
       CAST({_status_rank_sql('second_pass_munchable')} AS INTEGER) AS status_rank
FROM (
  SELECT c.seq, c.contract_number,
         CASE WHEN u.k IS NULL THEN c.first_pass_munchable ELSE u.fpm END AS first_pass_munchable,
         CASE WHEN u.k IS NULL THEN c.first_pass_reason ELSE u.fpr END AS first_pass_reason,
         CASE WHEN u.k IS NULL THEN c.second_pass_munchable ELSE u.spm END AS second_pass_munchable,
         CASE WHEN u.k IS NULL THEN c.second_pass_reason ELSE u.spr END AS second_pass_reason
  FROM contracts c LEFT JOIN (
    SELECT contract_number AS k, arg_max_null(first_pass_munchable, aseq) AS fpm, arg_max_null(first_pass_reason, aseq) AS fpr,
           arg_max_null(lower(second_pass_munchable), aseq) AS spm,
           arg_max_null(CASE WHEN second_pass_reason IS NULL OR second_pass_reason IN ('', 'nan') THEN 'No reason provided'
                        ELSE second_pass_reason END, aseq) AS spr
    FROM pass2_answers WHERE contract_number NOT IN {SENT} AND contract_number IS NOT NULL GROUP BY 1
  ) u ON c.contract_number = u.k) t""", "pass2_answers"))
def q_upsert_results(spark, sf):
    a = tables.pass2_answers(spark, sf)
    st, rs = normalize_status("second_pass_munchable", "second_pass_reason")
    updates = a.withColumns({"second_pass_munchable": st, "second_pass_reason": rs}).withColumnRenamed("aseq", "useq")
    out = R.order_by_status(R.upsert_results(_c(spark, sf), updates))
    return out.select("seq", "contract_number", *R.UPSERT_COLUMNS, "status_rank")


@query("upsert_versioned", REGISTRY["upsert_results"].sql,
       note="two writes to a versioned table: buckets with changed keys are rewritten, then the commit pointer moves")
def q_upsert_versioned(spark, sf):
    a = tables.pass2_answers(spark, sf)
    st, rs = normalize_status("second_pass_munchable", "second_pass_reason")
    updates = a.withColumns({"second_pass_munchable": st, "second_pass_reason": rs}).withColumnRenamed("aseq", "useq")
    table = VersionedTable(spark, scratch(spark, "versioned"))
    table.create(_c(spark, sf), buckets=16)
    early = F.pmod(F.xxhash64("contract_number"), F.lit(2)) == 0  # each key's answers come in one of two batches
    for batch in (updates.where(early), updates.where(~early)):
        table.upsert(batch)
    return R.order_by_status(R.upsert_results(table.read(), updates.limit(0))).select(
        "seq", "contract_number", *R.UPSERT_COLUMNS, "status_rank")


@query("order_by_status", S.with_ctes(f"""
SELECT seq, contract_number, second_pass_munchable, CAST({_status_rank_sql('second_pass_munchable')} AS INTEGER)
       AS status_rank
FROM contracts ORDER BY status_rank NULLS LAST, seq""", "contracts"))
def q_order_by_status(spark, sf):
    return R.order_by_status(_c(spark, sf)).select("seq", "contract_number", "second_pass_munchable", "status_rank")


_PARENTS = f"""
SELECT contract_number AS pk, arg_min_null(description, seq) AS parent_description FROM contracts
WHERE contract_number IS NOT NULL AND contract_number <> '' AND contract_number NOT IN {SENT} GROUP BY 1"""

_CHILDREN = f"""
SELECT parent_contract_number AS ck,
       'Child Contract Descriptions:' || chr(10) ||
       string_agg('- ' || coalesce(description, '') || chr(10), '' ORDER BY seq) AS child_block
FROM contracts WHERE parent_contract_number IS NOT NULL AND parent_contract_number <> ''
  AND parent_contract_number NOT IN {SENT} GROUP BY 1"""


@query("context_parent", S.with_ctes(f"""
SELECT c.seq, c.contract_number, p.parent_description
FROM contracts c LEFT JOIN ({_PARENTS}) p ON c.parent_contract_number = p.pk""", "contracts"))
def q_context_parent(spark, sf):
    return R.context_parent(_c(spark, sf)).select("seq", "contract_number", "parent_description")


@query("context_children", S.with_ctes(f"""
SELECT ck AS parent_contract_number, substring(child_block, 1, 10000) AS child_block FROM ({_CHILDREN}) k""", "contracts"))
def q_context_children(spark, sf):
    return R.context_children(_c(spark, sf)).withColumnRenamed("_ckey", "parent_contract_number")


def _context_sql(budget: int) -> str:
    return S.with_ctes(f"""
SELECT c.seq, c.contract_number,
       substring('Current Contract Description: ' || coalesce(c.description, '') || chr(10) || chr(10) ||
                 CASE WHEN p.parent_description IS NOT NULL
                      THEN 'Parent Contract Description: ' || p.parent_description || chr(10) || chr(10) ELSE '' END ||
                 coalesce(k.child_block, ''), 1, {budget}) AS context_text
FROM contracts c LEFT JOIN ({_PARENTS}) p ON c.parent_contract_number = p.pk
LEFT JOIN ({_CHILDREN}) k ON c.contract_number = k.ck""", "contracts")


@query("context_text", _context_sql(10_000))
def q_context_text(spark, sf):
    return R.context_text(_c(spark, sf)).select("seq", "contract_number", "context_text")


@query("context_text_short", _context_sql(100), note="a small text budget")
def q_context_text_short(spark, sf):
    return R.context_text(_c(spark, sf), budget=100).select("seq", "contract_number", "context_text")


@query("context_text_long", _context_sql(1_000_000), note="a budget that holds every child of the largest parent")
def q_context_text_long(spark, sf):
    return R.context_text(_c(spark, sf), budget=1_000_000).select("seq", "contract_number", "context_text")


@query("build_request", S.with_ctes(f"""
SELECT c.seq, c.contract_number,
       'Review the contract below.' || chr(10) || substring('Current Contract Description: ' || coalesce(c.description, '')
       || chr(10) || chr(10) ||
                 CASE WHEN p.parent_description IS NOT NULL
                      THEN 'Parent Contract Description: ' || p.parent_description || chr(10) || chr(10) ELSE '' END ||
                 coalesce(k.child_block, ''), 1, 10000) || chr(10) || 'Answer as JSON.' AS request_text
FROM contracts c LEFT JOIN ({_PARENTS}) p ON c.parent_contract_number = p.pk
LEFT JOIN ({_CHILDREN}) k ON c.contract_number = k.ck""", "contracts"))
def q_build_request(spark, sf):
    from quire.operators.extract import build_request
    ctx = R.context_text(_c(spark, sf))
    return ctx.select("seq", "contract_number",
                      build_request("context_text", "Review the contract below.\n", "\nAnswer as JSON.")
                      .alias("request_text"))


@query("parent_child_verdict", S.with_ctes(f"""
SELECT c.seq, c.contract_number,
       CASE WHEN p.pv = 'false' THEN 'false' ELSE lower(c.second_pass_munchable) END AS final_verdict
FROM contracts c LEFT JOIN (
  SELECT contract_number AS pk, arg_min_null(lower(second_pass_munchable), seq) AS pv FROM contracts
  WHERE contract_number IS NOT NULL AND contract_number <> '' AND contract_number NOT IN {SENT} GROUP BY 1) p
ON c.parent_contract_number = p.pk""", "contracts"))
def q_parent_child_verdict(spark, sf):
    return R.parent_child_verdict(_c(spark, sf)).select("seq", "contract_number", "final_verdict")


@query("chunk_rows", S.with_ctes("""
SELECT seq, contract_number, (row_number() OVER (ORDER BY seq) - 1) // 25 AS chunk_no FROM contracts""",
    "contracts"))
def q_chunk_rows(spark, sf):
    return R.chunk_rows(_c(spark, sf).select("seq", "contract_number"), 25)


@query("sample_first_n", S.with_ctes("SELECT seq, contract_number FROM contracts ORDER BY seq LIMIT 3", "contracts"))
def q_sample_first_n(spark, sf):
    return R.sample_first_n(_c(spark, sf).select("seq", "contract_number"), 3)


@query("status_distribution", S.with_ctes("""
SELECT 'first_pass_munchable' AS "column", first_pass_munchable AS status, count(*) AS n FROM contracts
WHERE first_pass_munchable IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'second_pass_munchable', second_pass_munchable, count(*) FROM contracts
WHERE second_pass_munchable IS NOT NULL GROUP BY 2""", "contracts"))
def q_status_distribution(spark, sf):
    return R.status_distribution(_c(spark, sf), ["first_pass_munchable", "second_pass_munchable"])


@query("normalize_status", S.with_ctes("""
SELECT seq, lower(first_pass_munchable) AS status,
       CASE WHEN first_pass_reason IS NULL OR first_pass_reason IN ('', 'nan') THEN 'No reason provided'
            ELSE first_pass_reason END AS reason
FROM contracts""", "contracts"))
def q_normalize_status(spark, sf):
    st, rs = normalize_status("first_pass_munchable", "first_pass_reason")
    return _c(spark, sf).select("seq", st.alias("status"), rs.alias("reason"))


@query("clean_reason", S.with_ctes(f"""
SELECT seq, {_clean_reason_sql('first_pass_reason')} AS first_pass_reason,
       {_clean_reason_sql('second_pass_reason')} AS second_pass_reason FROM contracts""", "contracts"))
def q_clean_reason(spark, sf):
    return _c(spark, sf).select("seq", clean_reason("first_pass_reason").alias("first_pass_reason"),
                                clean_reason("second_pass_reason").alias("second_pass_reason"))


@query("path_key", S.with_ctes("SELECT seq, file_path, md5(file_path) AS path_md5 FROM contracts", "contracts"))
def q_path_key(spark, sf):
    return _c(spark, sf).select("seq", "file_path", path_key("file_path").alias("path_md5"))


@query("file_stem", S.with_ctes(r"""
SELECT seq, regexp_extract(regexp_extract(file_path, '([^/\\]*)$', 1), '^(.+)\.[^.]*$', 1) AS stem FROM contracts""",
    "contracts"))
def q_file_stem(spark, sf):
    return _c(spark, sf).select("seq", file_stem("file_path").alias("stem"))


@query("safe_file_name", S.with_ctes(r"""
SELECT seq, regexp_replace(description, '[^\p{L}\p{N}._\- ]', '', 'g') || '.pdf' AS file_name FROM contracts""",
    "contracts"))
def q_safe_file_name(spark, sf):
    return _c(spark, sf).select("seq", F.concat(safe_file_name("description"), F.lit(".pdf")).alias("file_name"))


_CHUNKED = """
chunked AS (SELECT *, (row_number() OVER (ORDER BY seq) - 1) // 25 AS chunk_no FROM contracts)"""


@query("context_text_chunked", S.with_ctes(f"""
SELECT c.seq, c.contract_number, c.chunk_no,
       substring('Current Contract Description: ' || coalesce(c.description, '') || chr(10) || chr(10) ||
                 CASE WHEN p.parent_description IS NOT NULL
                      THEN 'Parent Contract Description: ' || p.parent_description || chr(10) || chr(10) ELSE '' END ||
                 coalesce(k.child_block, ''), 1, 10000) AS context_text
FROM chunked c
LEFT JOIN (SELECT contract_number AS pk, chunk_no AS pc, arg_min_null(description, seq) AS parent_description
           FROM chunked WHERE contract_number IS NOT NULL AND contract_number <> '' AND contract_number NOT IN {SENT}
           GROUP BY 1, 2) p ON c.parent_contract_number = p.pk AND c.chunk_no = p.pc
LEFT JOIN (SELECT parent_contract_number AS ck, chunk_no AS kc,
                  'Child Contract Descriptions:' || chr(10) ||
                  string_agg('- ' || coalesce(description, '') || chr(10), '' ORDER BY seq) AS child_block
           FROM chunked WHERE parent_contract_number IS NOT NULL AND parent_contract_number <> ''
             AND parent_contract_number NOT IN {SENT} GROUP BY 1, 2) k
ON c.contract_number = k.ck AND c.chunk_no = k.kc""", "contracts", extra=[_CHUNKED]))
def q_context_text_chunked(spark, sf):
    """Chunk-local context (the reference looks up parents and children inside its 25-row chunk only)."""
    chunked = R.chunk_rows(_c(spark, sf), 25)
    return R.context_text(chunked, within=["chunk_no"]).select("seq", "contract_number", "chunk_no", "context_text")
