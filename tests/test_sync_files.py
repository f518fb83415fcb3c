import json

from pyspark.sql import functions as F

from quire.operators import sync
from quire.sources import files


def test_blob_sync_plan(spark):
    remote = spark.createDataFrame([("a.pdf", 10), ("b.PDF", 20), ("c.txt", 5), ("d.pdf", 7)], "name string, size long")
    local = spark.createDataFrame([("a.pdf", 10), ("b.PDF", 21)], "name string, size long")
    got = {r.name: r.action for r in sync.blob_sync_plan(remote, local).collect()}
    assert got == {"a.pdf": "skip", "b.PDF": "fetch", "d.pdf": "fetch"}


def test_archive_manifest_statuses(spark):
    rec = spark.createDataFrame([(1, "C/1", "p1"), (2, "C1", "p2"), (3, "Error", "p3"), (4, "***", "p4"),
                                 (5, "C9", "p5"), (6, None, "p6")], "seq long, cid string, file_path string")
    archived = spark.createDataFrame([("C9.pdf",)], "dest string")
    got = {r.seq: (r.dest, r.status) for r in sync.archive_manifest(rec, "cid", archived=archived).collect()}
    assert got == {1: ("C1.pdf", "copied"), 2: ("C1.pdf", "exists"), 3: (None, "invalid"), 4: (None, "invalid"),
                   5: ("C9.pdf", "exists"), 6: (None, "invalid")}


def test_moderation_payload_keeps_nulls(spark):
    docs = spark.createDataFrame([("/x/doc 1.pdf", "hello"), ("/x/empty.pdf", None)], "path string, text string")
    out = {r.path: r for r in sync.moderation_payload(docs, "cid").collect()}
    p = json.loads(out["/x/doc 1.pdf"].payload)
    assert list(p) == ["clientId", "name", "entity", "content", "vendor_name", "passthrough", "fy25_value",
                       "total_value", "contracting_officer", "contract_number"]
    assert p["name"] == p["contract_number"] == "doc 1" and p["vendor_name"] is None and p["passthrough"] is False
    s = sync.push_summary(sync.moderation_payload(docs, "cid")).first()
    assert (s.n_success, s.n_failure) == (1, 1)


def test_ledger_formats_round_trip(spark, tmp_dir):
    paths = spark.range(0, 50).select(F.concat(F.lit("/f/"), F.col("id"), F.lit(".pdf")).alias("path")).repartition(4)
    files.write_processed_log(paths, f"{tmp_dir}/json", fmt="json-array")
    back = files.load_ledger(spark, f"{tmp_dir}/json", fmt="json-array")
    assert sorted(r.path for r in back.collect()) == sorted(r.path for r in paths.collect())
    spark.createDataFrame([("a", "x")], "other string, y string").write.option("header", True).csv(f"{tmp_dir}/csv")
    assert files.load_ledger(spark, f"{tmp_dir}/csv", fmt="csv", key="contract_number").count() == 0


def test_scan_documents_skips_missing_roots(spark, tmp_dir):
    spark.createDataFrame([("a",), ("b",)], "value string").coalesce(1).write.text(f"{tmp_dir}/docs")
    got = files.scan_documents(spark, [f"{tmp_dir}/docs", f"{tmp_dir}/missing"], glob="*.txt")
    assert got.count() == 1 and got.columns == ["path", "length", "modificationTime"]
    assert files.scan_documents(spark, f"{tmp_dir}/missing").count() == 0


def test_text_cache_version_key(spark):
    from quire.functions.text import path_key
    from quire.operators import documents as D
    docs = spark.createDataFrame([("/a.pdf", 10), ("/b.pdf", 20)], "file_path string, length long")
    cache = docs.select(path_key("file_path").alias("path_md5"), F.lit(10).cast("long").alias("length"),
                        F.lit("cached").alias("text"))
    fresh = lambda df: df.withColumn("text", F.lit("extracted"))
    by_path, _ = D.text_cache_lookup(docs, cache, fresh)
    assert {r.file_path: r.text for r in by_path.collect()} == {"/a.pdf": "cached", "/b.pdf": "cached"}
    by_version, new_rows = D.text_cache_lookup(docs, cache, fresh, version=["length"])
    assert {r.file_path: r.text for r in by_version.collect()} == {"/a.pdf": "cached", "/b.pdf": "extracted"}
    assert new_rows.count() == 1


def test_a_csv_file_has_few_rows(spark, tmp_dir, monkeypatch):
    """Files with quoted line breaks are not split, so large results must be many files."""
    monkeypatch.setattr(files, "CSV_ROWS", 10, raising=False)
    df = spark.range(95).selectExpr("id", "concat('two\nlines ', id) as text").coalesce(1)
    files.write_results_csv(df, f"{tmp_dir}/results")
    back = files.scan_results_csv(spark, f"{tmp_dir}/results", df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    rows = back.selectExpr("input_file_name() as f").groupBy("f").count().collect()
    assert len(rows) == 10 and max(r["count"] for r in rows) == 10
