"""End-to-end reviews over the contracts and memos adapters: both passes, with captured model answers.

Some files are processed already, have no text, or get no answer; some answers come twice, cannot be used or carry a
sentinel or an id that is known already.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import extract as X
from quire.operators import review
from quire.plans import docs_queries as DQ
from quire.plans import sql_parts as S
from quire.plans.registry import query
from quire.sources import tables

SENT = "('Not found', 'Error')"
ASK1 = review.Template("Fill in the fields of this contract as JSON.\n\n", "\n")
ASK2 = review.Template("Give the second status of this contract.\n\n", "\n")

_CONTRACT_CTES = [
    """todo AS (SELECT seq AS nr, file_path AS path, CASE WHEN seq % 11 = 0 THEN '' ELSE description END AS text FROM contracts
             WHERE file_path NOT IN (SELECT path FROM processed_log WHERE coalesce(status, '') <> 'retry'))""",
    f"""rq1 AS (SELECT c.file_path AS seq, {DQ.CONTRACT_P1_RESPONSE} AS response FROM contracts c
             JOIN todo t ON c.file_path = t.path WHERE coalesce(length(t.text), 0) > 0 AND c.seq % 13 <> 5)""",
    f"rq2 AS (SELECT file_path AS seq, {DQ.CONTRACT_P2_RESPONSE} AS response FROM contracts WHERE seq % 7 <> 3)",
]

_SQL = S.with_ctes(f"""
SELECT k.file_path, k.contract_number, k.first_pass_munchable,
       CASE WHEN a.request_id IS NOT NULL THEN lower(a.st) ELSE '' END AS second_pass_munchable,
       CASE WHEN a.request_id IS NULL THEN ''
            WHEN a.rs IS NULL OR a.rs IN ('', 'nan') THEN 'No reason provided' ELSE a.rs END AS second_pass_reason,
       CAST(CASE lower(CASE WHEN a.request_id IS NOT NULL THEN lower(a.st) ELSE '' END)
            WHEN 'true' THEN 0 WHEN 'false' THEN 1 WHEN 'n/a' THEN 2 WHEN 'error' THEN 3 WHEN '' THEN 4 END
            AS INTEGER) AS status_rank
FROM (SELECT seq AS file_path, contract_number, first_pass_munchable
      FROM ({DQ._decode_sql("rq1", X.CONTRACT_PASS1)}) r
      WHERE contract_number NOT IN (SELECT contract_number FROM reviewed_ledger WHERE contract_number NOT IN {SENT})) k
LEFT JOIN (SELECT seq AS request_id, second_pass_munchable AS st, second_pass_reason AS rs
           FROM ({DQ._decode_sql("rq2", X.CONTRACT_PASS2)}) d) a
ON k.file_path = a.request_id""", "processed_log", "reviewed_ledger", extra=_CONTRACT_CTES)


def _contract_run(spark, sf):
    c = tables.contracts(spark, sf)
    asked = c.where("seq % 13 <> 5")
    answers = asked.selectExpr("file_path as path", f"{DQ.CONTRACT_P1_RESPONSE} as response", "1 as aseq").unionByName(
        asked.where("seq % 17 = 0").selectExpr("file_path as path", "'' as response", "0 as aseq"))
    return review.contract_review(
        files=c.select(F.col("file_path").alias("path")),
        processed=tables.processed_log(spark, sf),
        reviewed=tables.reviewed_ledger(spark, sf),
        texts=c.selectExpr("file_path as path", "case when seq % 11 = 0 then '' else description end as text"),
        answers1=answers,
        answers2=c.where("seq % 7 <> 3").selectExpr("file_path as path", f"{DQ.CONTRACT_P2_RESPONSE} as response", "seq as aseq"),
        run_date=tables.RUN_DATE, template1=ASK1, template2=ASK2)


@query("contract_review_run", _SQL, note="both passes composed; model answers captured in tables")
def q_contract_review_run(spark, sf):
    return _contract_run(spark, sf)["results"].select(
        "file_path", "contract_number", "first_pass_munchable", "second_pass_munchable", "second_pass_reason", "status_rank")


@query("contract_review_ledger", S.with_ctes(f"""
SELECT t.path, CASE WHEN coalesce(length(t.text), 0) = 0 THEN 'no_text' WHEN r.seq IS NULL THEN 'retry'
                    WHEN r.is_error THEN 'error' ELSE 'ok' END AS status
FROM todo t LEFT JOIN ({DQ._decode_sql("rq1", X.CONTRACT_PASS1)}) r ON t.path = r.seq""",
    "processed_log", extra=_CONTRACT_CTES[:2]), note="ledger rows of the run: unanswered files stay open")
def q_contract_review_ledger(spark, sf):
    return _contract_run(spark, sf)["processed_rows"].select("path", "status")


@query("contract_second_pass", S.with_ctes(f"""
SELECT c.file_path, CASE WHEN a.seq IS NULL THEN c.second_pass_munchable ELSE lower(a.second_pass_munchable) END AS second_pass_munchable,
       CASE WHEN a.seq IS NULL THEN coalesce(c.second_pass_reason, '')
            WHEN a.second_pass_reason IN ('', 'nan') THEN 'No reason provided' ELSE a.second_pass_reason END AS second_pass_reason
FROM contracts c LEFT JOIN ({DQ._decode_sql("rq2", X.CONTRACT_PASS2)}) a ON c.file_path = a.seq""",
    "contracts", extra=_CONTRACT_CTES[2:]), note="second pass over results of an earlier run")
def q_contract_second_pass(spark, sf):
    c = tables.contracts(spark, sf)
    answers = c.where("seq % 7 <> 3").selectExpr("file_path as path", f"{DQ.CONTRACT_P2_RESPONSE} as response", "seq as aseq")
    return review.contract_second_pass(c, answers, ASK2)["results"].select(
        "file_path", "second_pass_munchable", "second_pass_reason")


_MEMO_CTES = [*DQ.RESP_CTES, f"""
mtodo AS (SELECT '/memos/' || source || '/M' || doc_id || '.pdf' AS path, doc_id, text FROM documents WHERE doc_id % 4 <> 0)""", f"""
mq1 AS (SELECT t.path AS seq, {DQ.MEMO_P1_RESPONSE} AS response FROM documents d JOIN mtodo t ON d.doc_id = t.doc_id
        LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE length(t.text) > 0 AND d.doc_id % 13 <> 5)""", f"""
mq2 AS (SELECT t.path AS seq, {DQ.memo_p2_response('d.')} AS response FROM documents d JOIN mtodo t ON d.doc_id = t.doc_id)""", f"""
mkept AS (SELECT * FROM ({DQ._decode_sql("mq1", X.MEMO_PASS1)}) r WHERE memo_id IN {SENT}
          OR memo_id NOT IN (SELECT 'M' || doc_id FROM documents WHERE doc_id % 5 = 0))"""]

_MEMO_SQL = S.with_ctes(f"""
SELECT r.seq AS path, r.memo_id, r.first_pass_non_compliance_score,
       CASE WHEN u.k IS NULL THEN 0 ELSE u.s END AS second_pass_score,
       CASE WHEN u.k IS NULL THEN '' ELSE u.p END AS priority_level,
       r.memo_id NOT IN {SENT} AND (r.first_pass_non_compliance_score >= 5
         OR lower(CASE WHEN u.k IS NULL THEN '' ELSE u.p END) = 'high') AS flagged
FROM mkept r
LEFT JOIN (SELECT memo_id AS k, arg_max_null(second_pass_score, seq) AS s, arg_max_null(priority_level, seq) AS p
           FROM ({DQ._decode_sql("mq2", X.MEMO_PASS2)}) t
           WHERE memo_id NOT IN {SENT} AND seq IN (SELECT seq FROM mkept) GROUP BY 1) u ON r.memo_id = u.k""",
    "contracts", extra=_MEMO_CTES)


def _memo_run(spark, sf):
    m = tables.memos(spark, sf)
    d = tables.load(spark, sf, "documents").alias("d")
    lab = tables.load(spark, sf, "labels", spread_rows=False).alias("l")
    keyed = d.join(lab, F.col("d.doc_id") == F.col("l.doc_id"), "left").withColumn(
        "path", F.concat(F.lit("/memos/"), F.col("d.source"), F.lit("/M"), F.col("d.doc_id"), F.lit(".pdf")))
    return review.memo_review(
        files=m.select(F.col("file_path").alias("path")),
        processed=m.where("seq % 4 = 0").select(F.col("file_path").alias("path"), F.lit("ok").alias("status")),
        known=tables.load(spark, sf, "documents").where("doc_id % 5 = 0").selectExpr(
            "concat('M', doc_id) as memo_id", "'2024-12-31' as review_date"),
        texts=m.select(F.col("file_path").alias("path"), "text"),
        answers1=keyed.where("d.doc_id % 13 <> 5").selectExpr("path", f"{DQ.MEMO_P1_RESPONSE} as response", "1 as aseq"),
        answers2=keyed.selectExpr("path", f"{DQ.memo_p2_response('d.')} as response", "1 as aseq"),
        run_date=tables.RUN_DATE)


@query("memo_review_run", _MEMO_SQL, note="memo flow composed end to end; model answers captured in tables")
def q_memo_review_run(spark, sf):
    return _memo_run(spark, sf)["results"].select(
        F.col("file_path").alias("path"), "memo_id", "first_pass_non_compliance_score", "second_pass_score",
        "priority_level", "flagged")


@query("memo_review_ledger", S.with_ctes(f"""
SELECT t.path, CASE WHEN coalesce(length(t.text), 0) = 0 THEN 'no_text' WHEN r.seq IS NULL THEN 'retry'
                    WHEN r.is_error THEN 'error' ELSE 'ok' END AS status
FROM mtodo t LEFT JOIN ({DQ._decode_sql("mq1", X.MEMO_PASS1)}) r ON t.path = r.seq""",
    "contracts", extra=_MEMO_CTES[:-2]), note="ledger rows of the memo run")
def q_memo_review_ledger(spark, sf):
    return _memo_run(spark, sf)["processed_rows"].select("path", "status")


@query("priority_distribution", _MEMO_SQL.replace("SELECT r.seq AS path", """
SELECT 'priority_level' AS "column", priority_level AS status, count(*) AS n FROM (SELECT r.seq AS path""", 1)
    + ") z GROUP BY 1, 2", note="memos per priority, most frequent first")
def q_priority_distribution(spark, sf):
    return _memo_run(spark, sf)["priorities"]
