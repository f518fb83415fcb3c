"""The pipeline on a small folder: every stage's decisions take effect, clean documents stay."""

import os

import corpus_pipeline
from helpers import frame, hard_texts, prose, with_odd_rows
from test_models import insult

import __spark_entry__


def folder(spark, tmp_dir, docs):
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    labels = [(i, 1, int(i >= 100 and i % 4 == 0)) for i in range(100, 1000)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    return tmp_dir


def test_stages(spark, tmp_dir):
    hard = hard_texts()
    texts = hard + [prose(i, 60) for i in range(len(hard), 100)] + [insult(i, 60) if i % 4 == 0 else prose(i, 60) for i in range(100, 1000)]
    sf = folder(spark, tmp_dir, with_odd_rows(frame(spark, texts)))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "packing":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        path = os.path.join(tmp_dir, "out-" + name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = [r.doc_id for r in docs.collect()]
    toxic = {i for i in range(100, 1000) if i % 4 == 0}
    assert len(toxic & set(kept["toxicity"])) < 10 and len(set(range(100, 1000)) - toxic - set(kept["toxicity"])) < 10
    copies = set(kept["exact_dedup"])
    assert 6 not in copies and 7 in copies and 14 not in copies and 15 in copies
    near = set(kept["ngram_jaccard"])
    assert 7 in near and not {8, 9, 10} & near and {15, 20, 30} <= near
    assert max(kept["source_mix"].count(i) for i in near if i) == 2
    assert set(kept["packing"]) == set(kept["source_mix"])


def test_empty_table(spark, tmp_dir):
    sf = folder(spark, tmp_dir, frame(spark, ["x"]).where("false"))
    assert corpus_pipeline.run(spark, sf).collect() == []


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 14)}


def test_queries_against_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    for name, sql in __spark_entry__.LLM_SQL.items():
        out = __spark_entry__.LLM[name](spark, sf)
        want = con.sql(sql)
        assert sorted(out.columns) == sorted(want.columns)
        cols = sorted(out.columns)
        rows = sorted(tuple(map(str, (r[c] for c in cols))) for r in out.collect())
        assert rows == sorted(tuple(map(str, r)) for r in want.select(*cols).fetchall()), name
