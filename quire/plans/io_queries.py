"""Sync / archive / payload tables, file listings, CSV and ledger round trips, streaming ingest.

File operators write into a fresh folder under the session's shared checkpoint folder and return what Spark
reads back, so the check compares logical content.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quire import schemas
from quire.operators import documents as D
from quire.operators import extract as X
from quire.operators import sync
from quire.plans import docs_queries as DQ
from quire.plans import sql_parts as S
from quire.plans.org_queries import scratch
from quire.plans.registry import REGISTRY, query
from quire.sources import files, folders, tables
from quire.streaming.ingest import incremental_ingest, keyed_ingest

CLIENT_ID = "client-1"


@query("blob_inventory", S.with_ctes("SELECT name, size FROM remote_inventory WHERE suffix(lower(name), '.pdf')",
                                     "remote_inventory"))
def q_blob_inventory(spark, sf):
    return sync.blob_inventory(tables.remote_inventory(spark, sf)).select("name", "size")


@query("blob_sync_plan", S.with_ctes("""
SELECT r.name, r.size, l.size AS local_size, CASE WHEN l.size = r.size THEN 'skip' ELSE 'fetch' END AS action
FROM remote_inventory r LEFT JOIN local_inventory l ON r.name = l.name
WHERE suffix(lower(r.name), '.pdf')""", "remote_inventory", "local_inventory"))
def q_blob_sync_plan(spark, sf):
    plan = sync.blob_sync_plan(tables.remote_inventory(spark, sf), tables.local_inventory(spark, sf))
    return plan.select("name", "size", "local_size", "action")


@query("archive_manifest", S.with_ctes(r"""
SELECT seq, contract_number, dest,
       CASE WHEN dest IS NULL THEN 'invalid' WHEN seq <> min(seq) OVER (PARTITION BY dest) THEN 'exists'
            ELSE 'copied' END AS status
FROM (SELECT seq, contract_number,
             CASE WHEN contract_number IS NULL OR contract_number IN ('Not found', 'Error', '')
                       OR regexp_replace(contract_number, '[^\p{L}\p{N}._\- ]', '', 'g') = '' THEN NULL
                  ELSE regexp_replace(contract_number, '[^\p{L}\p{N}._\- ]', '', 'g') || '.pdf' END AS dest
      FROM pass1_records) t""", "pass1_records"))
def q_archive_manifest(spark, sf):
    m = sync.archive_manifest(tables.pass1_records(spark, sf), "contract_number")
    return m.select("seq", "contract_number", "dest", "status")


_FLAGGED_SQL = f"""
SELECT memo_id, min(seq) AS seq FROM (
  SELECT seq, memo_id FROM ({DQ._decode_sql("m_p1", X.MEMO_PASS1)}) a
  WHERE first_pass_non_compliance_score >= 5 AND memo_id NOT IN ('Not found', 'Error')
  UNION ALL
  SELECT seq, memo_id FROM ({DQ._decode_sql("m_p2", X.MEMO_PASS2)}) b
  WHERE lower(priority_level) = 'high' AND memo_id NOT IN ('Not found', 'Error')) f GROUP BY memo_id"""


@query("archive_manifest_memos", DQ._q(rf"""
SELECT seq, memo_id, dest,
       CASE WHEN dest IS NULL THEN 'invalid' WHEN seq <> min(seq) OVER (PARTITION BY dest) THEN 'exists'
            ELSE 'copied' END AS status
FROM (SELECT seq, memo_id, regexp_replace(memo_id, '[^\p{{L}}\p{{N}}._\- ]', '', 'g') || '.pdf' AS dest
      FROM ({_FLAGGED_SQL}) f) t"""))
def q_archive_manifest_memos(spark, sf):
    """Memos archive only the flagged set: first-pass score >= 5 or second-pass priority high."""
    p1 = X.decode_response(DQ.memo_p1(spark, sf), "response", X.MEMO_PASS1)
    p2 = X.decode_response(DQ.memo_p2(spark, sf), "response", X.MEMO_PASS2)
    from quire.functions.text import is_sentinel
    flagged = (p1.where((F.col("first_pass_non_compliance_score") >= 5) & ~is_sentinel("memo_id")).select("seq", "memo_id")
               .unionByName(p2.where((F.lower("priority_level") == "high") & ~is_sentinel("memo_id"))
                            .select("seq", "memo_id"))
               .groupBy("memo_id").agg(F.min("seq").alias("seq")))
    m = sync.archive_manifest(flagged.withColumn("file_path", F.lit(None).cast("string")), "memo_id")
    return m.select("seq", "memo_id", "dest", "status")


_PAYLOAD_DOCS = f"""
SELECT '/pdfs/' || doc_id || '.pdf' AS path,
       nullif({S.strip_ws(f"string_agg(CASE WHEN {S.strip_ws('page_text')} <> '' THEN page_text || chr(10) END, '' ORDER BY page_no)")}, '') AS text
FROM page_texts GROUP BY doc_id"""


def _payload_docs(spark, sf):
    pages = tables.page_texts(spark, sf)
    return D.concat_pages(pages, ok=None, sep="\n", strip=True).select(
        F.concat(F.lit("/pdfs/"), F.col("doc_id"), F.lit(".pdf")).alias("path"), "text")


@query("moderation_payload", S.with_ctes(f"""
SELECT path, json_object('clientId', '{CLIENT_ID}', 'name', regexp_extract(path, '([^/]*)\\.pdf$', 1),
                         'entity', 'contract', 'content', text, 'vendor_name', NULL::VARCHAR, 'passthrough', false,
                         'fy25_value', NULL::VARCHAR, 'total_value', NULL::VARCHAR,
                         'contracting_officer', NULL::VARCHAR,
                         'contract_number', regexp_extract(path, '([^/]*)\\.pdf$', 1))::VARCHAR AS payload,
       text IS NOT NULL AS has_content
FROM ({_PAYLOAD_DOCS}) d""", "page_texts"))
def q_moderation_payload(spark, sf):
    return sync.moderation_payload(_payload_docs(spark, sf), CLIENT_ID)


@query("push_summary", S.with_ctes(f"""
SELECT count(*) FILTER (WHERE text IS NOT NULL) AS n_success, count(*) FILTER (WHERE text IS NULL) AS n_failure
FROM ({_PAYLOAD_DOCS}) d""", "page_texts"))
def q_push_summary(spark, sf):
    return sync.push_summary(sync.moderation_payload(_payload_docs(spark, sf), CLIENT_ID))


@query("elapsed_stats", """
SELECT event_type, count(*) AS n_items,
       (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 AS elapsed_s,
       (epoch_us(max(ts)) - epoch_us(min(ts))) / count(*) / 1000000.0 AS s_per_item
FROM events GROUP BY event_type""")
def q_elapsed_stats(spark, sf):
    ev = tables.load(spark, sf, "events").select("event_type", "ts")
    return sync.elapsed_stats(ev, "event_type").select("event_type", "n_items", "elapsed_s", "s_per_item")


# ---------------------------------------------------------------- listings and round trips


def _land_memos(spark, sf, by: str) -> str:
    """Memo texts written as text files in one folder per ``by`` value (the document landing area)."""
    root = scratch(spark, "landing")
    tables.memos(spark, sf).select(by, "text").write.partitionBy(by).text(root)
    return root


@query("scan_documents", S.with_ctes(
    "SELECT 'source=' || source AS folder, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes FROM memos GROUP BY 1", "memos"))
def q_scan_documents(spark, sf):
    root = _land_memos(spark, sf, "source")
    listing = files.scan_documents(spark, root, recursive=True, glob="*.txt")
    return (listing.withColumn("folder", F.regexp_extract("path", r"/(source=[^/]+)/", 1))
            .groupBy("folder").agg(F.sum("length").alias("n_bytes")))


@query("all_pdfs", S.with_ctes(
    "SELECT 'lang=' || lang AS folder, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes FROM memos GROUP BY 1", "memos"))
def q_all_pdfs(spark, sf):
    """Listings over several folders (one per language) plus one missing folder, concatenated."""
    root = _land_memos(spark, sf, "lang")
    roots = [f"{root}/{name}" for name in folders.names(spark, root) if name.startswith("lang=")] + [f"{root}/lang=missing"]
    listing = files.scan_documents(spark, roots, recursive=False, glob="*.txt")
    return (listing.withColumn("folder", F.regexp_extract("path", r"/(lang=[^/]+)/", 1))
            .groupBy("folder").agg(F.sum("length").alias("n_bytes")))


_STRING_COLS = [f.name for f in schemas.CONTRACT_RESULT.fields if f.dataType.typeName() == "string"]


@query("scan_results_csv", S.with_ctes(
    "SELECT * REPLACE (" + ", ".join(f"nullif({c}, '') AS {c}" for c in _STRING_COLS) + ") FROM contracts",
    "contracts"))
def q_scan_results_csv(spark, sf):
    path = scratch(spark, "results-csv")
    files.write_results_csv(tables.contracts(spark, sf), path)
    return files.scan_results_csv(spark, path, schemas.CONTRACT_RESULT)


@query("load_ledger", S.with_ctes("SELECT path FROM processed_log", "processed_log"))
def q_load_ledger(spark, sf):
    path = scratch(spark, "ledger-json")
    files.write_processed_log(tables.processed_log(spark, sf), path, fmt="json-array")
    return files.load_ledger(spark, path, fmt="json-array")


@query("load_ledger_csv", S.with_ctes("SELECT DISTINCT contract_number FROM reviewed_ledger", "reviewed_ledger"))
def q_load_ledger_csv(spark, sf):
    path = scratch(spark, "ledger-csv")
    tables.reviewed_ledger(spark, sf).write.option("header", True).csv(path)
    return files.load_ledger(spark, path, fmt="csv", key="contract_number")


@query("write_processed_log", S.with_ctes("""
SELECT path, status, 'run1' AS run_id FROM processed_log
UNION ALL SELECT file_path, 'ok', 'run2' FROM contracts WHERE file_path NOT IN (SELECT path FROM processed_log)""",
    "processed_log"))
def q_write_processed_log(spark, sf):
    path = scratch(spark, "ledger-parquet")
    log = tables.processed_log(spark, sf)
    files.write_processed_log(log.withColumn("run_id", F.lit("run1")), path)
    new = (tables.contracts(spark, sf).select(F.col("file_path").alias("path"))
           .join(log.select("path"), "path", "left_anti")
           .withColumn("status", F.lit("ok")).withColumn("run_id", F.lit("run2")))
    files.write_processed_log(new, path)
    return files.load_ledger(spark, path, fmt="parquet")


# ---------------------------------------------------------------- streaming

def _landing_files(spark, sf) -> int:
    """Four files, or for a large table as many as its scan has tasks: what one task writes or reads of the landing does
    not grow with the table."""
    return max(4, tables.load(spark, sf, "documents", spread_rows=False).rdd.getNumPartitions())


@query("incremental_ingest", f"""
SELECT 'M' || doc_id AS memo_id, {DQ._first_rule_case('v', 'n/a')} AS verdict,
       CASE WHEN length(text) > 0 THEN 'ok' ELSE 'no_text' END AS status
FROM documents""", note="readStream + foreachBatch, availableNow, two runs (second is a no-op)")
def q_incremental_ingest(spark, sf):
    landing = scratch(spark, "stream-landing")
    out = scratch(spark, "stream-results")
    ledger = scratch(spark, "stream-ledger")
    ckpt = scratch(spark, "stream-ckpt")
    memos = tables.memos(spark, sf).select(F.col("file_path").alias("path"), "memo_id", "text")
    memos.repartition(_landing_files(spark, sf)).write.parquet(landing)
    schema = spark.read.parquet(landing).schema

    def process(df):
        return (X.classify_rules(df, "text", DQ.DOC_RULES, "n/a")
                .withColumn("status", F.when(F.length("text") > 0, F.lit("ok")).otherwise(F.lit("no_text")))
                .select("path", "memo_id", "verdict", "status"))

    for _ in range(2):  # the second run finds nothing new
        incremental_ingest(spark, landing, schema, out, ledger, ckpt, process, key="path", files_per_batch=2)
    return spark.read.parquet(out).select("memo_id", "verdict", "status")


@query("keyed_ingest", REGISTRY["incremental_ingest"].sql,
       note="keyed state in the RocksDB store; every file lands twice, some keys are taken up again by the second run")
def q_keyed_ingest(spark, sf):
    landing, out, ledger, retry, ckpt = (scratch(spark, f"keyed-{x}") for x in ("landing", "results", "ledger", "retry", "ckpt"))
    memos = tables.memos(spark, sf).select(F.col("file_path").alias("path"), "memo_id", "text")

    def process(df):
        return (X.classify_rules(df, "text", DQ.DOC_RULES, "n/a")
                .withColumn("status", F.when(F.length("text") > 0, F.lit("ok")).otherwise(F.lit("no_text")))
                .select("memo_id", "verdict", "status"))

    status = F.when((F.col("attempt") == 0) & (F.pmod(F.xxhash64("path"), F.lit(5)) == 0), "retry")
    for run in range(2):
        memos.repartition(_landing_files(spark, sf)).write.parquet(f"{landing}/run{run}")
        keyed_ingest(spark, landing, memos.schema, out, ledger, retry, ckpt, process, status=status)
    return spark.read.parquet(out).select("memo_id", "verdict", "status")


def _pages_of(data: bytes) -> list[str]:
    """Stand-in byte parser for the plug point: a landed text file's lines are its pages."""
    return bytes(data).decode("utf-8").split("\n")[:-1]


@query("extract_text", S.with_ctes("""
SELECT CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS n_pages,
       CAST(sum(length(replace(text, chr(10), ''))) AS BIGINT) AS n_chars
FROM memos""", "memos"), note="binaryFile source -> mapInPandas parser plug point -> page table")
def q_extract_text(spark, sf):
    root = _land_memos(spark, sf, "source")
    raw = (spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", True)
           .load(root))
    pages = D.extract_text(raw, _pages_of)
    return pages.agg(F.count(F.lit(1)).alias("n_pages"), F.sum(F.length("page_text")).alias("n_chars"))
