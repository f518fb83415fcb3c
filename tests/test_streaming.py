import pytest
from pyspark.sql import functions as F

from quire.streaming.ingest import incremental_ingest, keyed_ingest


def test_incremental_ingest_is_idempotent_and_incremental(spark, tmp_dir):
    landing, out, ledger, ckpt = (f"{tmp_dir}/{x}" for x in ("landing", "out", "ledger", "ckpt"))
    spark.range(0, 30).select(F.concat(F.lit("/d/"), F.col("id")).alias("path"), F.col("id").alias("n")) \
        .repartition(3).write.parquet(landing)
    schema = spark.read.parquet(landing).schema
    proc = lambda df: df.withColumn("doubled", F.col("n") * 2)
    incremental_ingest(spark, landing, schema, out, ledger, ckpt, proc, files_per_batch=1)
    incremental_ingest(spark, landing, schema, out, ledger, ckpt, proc)     # nothing new: no-op
    assert spark.read.parquet(out).count() == 30
    spark.range(30, 40).select(F.concat(F.lit("/d/"), F.col("id")).alias("path"), F.col("id").alias("n")) \
        .write.mode("append").parquet(landing)
    incremental_ingest(spark, landing, schema, out, ledger, ckpt, proc, files_per_batch=1)
    res = spark.read.parquet(out)
    assert res.count() == 40 and res.select("path").distinct().count() == 40
    assert spark.read.parquet(ledger).count() == 40


def test_replayed_batch_is_not_duplicated(spark, tmp_dir):
    from quire.streaming.ingest import process_batch
    out, ledger = f"{tmp_dir}/out", f"{tmp_dir}/ledger"
    b0 = spark.range(0, 5).select(F.col("id").cast("string").alias("path"))
    b1 = spark.range(3, 9).select(F.col("id").cast("string").alias("path"))
    proc = lambda df: df.withColumn("x", F.lit(1))
    process_batch(b0, 0, out, ledger, proc)
    process_batch(b1, 1, out, ledger, proc)
    process_batch(b1, 1, out, ledger, proc)          # replay of batch 1 after a failure
    res = spark.read.parquet(out)
    assert res.count() == 9 and res.select("path").distinct().count() == 9
    assert spark.read.parquet(ledger).count() == 9


def test_retry_is_asked_again_and_a_repeated_path_is_done_once(spark, tmp_dir):
    from quire.streaming.ingest import process_batch
    out, ledger = f"{tmp_dir}/out", f"{tmp_dir}/ledger"
    batch = spark.createDataFrame([("a",), ("a",), ("b",)], "path string")
    proc = lambda df: df.withColumn("x", F.lit(1))
    mark = lambda df: df.select("path", F.when(F.col("path") == "b", "retry").otherwise("ok").alias("status"))
    process_batch(batch, 0, out, ledger, proc, status=mark)
    process_batch(batch, 1, out, ledger, proc)
    assert sorted((r.path, r.batch_id) for r in spark.read.parquet(out).collect()) == [("a", 0), ("b", 0), ("b", 1)]


def test_a_broken_ledger_is_an_error(spark, tmp_dir):
    import os

    import pytest

    from quire.streaming.ingest import process_batch
    os.makedirs(f"{tmp_dir}/ledger")
    with open(f"{tmp_dir}/ledger/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        process_batch(spark.createDataFrame([("a",)], "path string"), 0, f"{tmp_dir}/out", f"{tmp_dir}/ledger", lambda d: d)


def test_keyed_ingest_remembers_retries_and_restarts(spark, tmp_dir):
    d = {x: f"{tmp_dir}/{x}" for x in ("in", "out", "ledger", "retry", "ckpt")}
    schema = "path string, text string"
    failing = {"on": True}

    def land(rows, name):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d['in']}/{name}")

    def run(status=None):
        def process(df):
            if failing["on"]:
                raise RuntimeError("stopped")
            return df.select("path", F.length("text").alias("n"))

        keyed_ingest(spark, d["in"], spark.createDataFrame([], schema).schema, d["out"], d["ledger"], d["retry"], d["ckpt"],
                     process, status=status)
        return sorted((r.path, r.n) for r in spark.read.parquet(d["out"]).collect())

    land([("a", "x"), ("b", "xx"), ("a", "x")], 1)
    once = F.when((F.col("path") == "b") & (F.col("attempt") == 0), "retry")
    with pytest.raises(Exception, match="stopped"):
        run(once)
    failing["on"] = False
    assert run(once) == [("a", 1)]  # the failed batch again; b is put off
    land([("a", "other"), ("c", "xxx"), ("b", "xx")], 2)
    assert run(once) == [("a", 1), ("b", 2), ("c", 3)]  # a is known, b is taken up once
    assert run(once) == [("a", 1), ("b", 2), ("c", 3)]
    ledger = sorted((r.path, r.status, r.attempt) for r in spark.read.parquet(d["ledger"]).collect())
    assert ledger == [("a", "ok", 0), ("b", "ok", 1), ("b", "retry", 0), ("c", "ok", 0)]
    # the state alone knows the keys: no batch reads the ledger or the results
    land([("a", "x"), ("b", "x"), ("d", "")], 3)
    d.update(out=f"{tmp_dir}/out2", ledger=f"{tmp_dir}/ledger2")
    assert run(once) == [("d", 0)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").endswith("HDFSBackedStateStoreProvider") \
        or not spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")


def test_landing_files_follow_the_table(spark, tmp_dir, monkeypatch):
    """Both ingest queries land a table of many parts in as many files, and take up each document once."""
    from quire.plans import io_queries as Q

    docs = spark.range(24).selectExpr("id as doc_id", "concat('memo ', id) as text", "'en' as lang", "'web' as source")
    docs.repartition(6).write.option("maxRecordsPerFile", 4).parquet(f"{tmp_dir}/documents.parquet")
    roots = {}
    monkeypatch.setattr(Q, "scratch", lambda spark, what: roots.setdefault(what, f"{tmp_dir}/{what}"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")  # a small file is a task of the scan
    try:
        for query, landing in ((Q.q_incremental_ingest, "stream-landing"), (Q.q_keyed_ingest, "keyed-landing/run0")):
            out = query(spark, tmp_dir)
            assert sorted(r.memo_id for r in out.collect()) == sorted(f"M{i}" for i in range(24))
            n = spark.read.parquet(f"{tmp_dir}/{landing}").selectExpr("input_file_name() as f").distinct().count()
            assert n > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
