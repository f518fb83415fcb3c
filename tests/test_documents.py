from pyspark.sql import functions as F

from quire.operators import documents as D


def test_concat_pages_many_blocks_in_order(spark):
    pages = [("d1", p, f"<{p}>", p % 50 != 7) for p in range(0, 300, 2)] + [("d2", 5, "x", True)]
    df = spark.createDataFrame(pages, "doc_id string, page_no int, page_text string, ok boolean").repartition(5)
    got = {r.doc_id: r.text for r in D.concat_pages(df).collect()}
    assert got["d1"] == "".join(f"<{p}>" for p in range(0, 300, 2) if p % 50 != 7)
    assert got["d2"] == "x"


def test_concat_pages_payload_mode(spark):
    df = spark.createDataFrame([("d", 0, " a "), ("d", 1, "  "), ("d", 2, "b"), ("e", 0, " \n ")],
                               "doc_id string, page_no int, page_text string")
    got = {r.doc_id: r.text for r in D.concat_pages(df, ok=None, sep="\n", strip=True).collect()}
    assert got == {"d": "a \nb", "e": None}          # a document of blank pages stays, with null text


def test_concat_pages_all_failed_pages_gives_empty_text(spark):
    df = spark.createDataFrame([("d", 0, "x", False), ("d", 1, "y", False)],
                               "doc_id string, page_no int, page_text string, ok boolean")
    got = D.drop_empty_text(D.concat_pages(df)).first()
    assert (got.text, got.status) == ("", "no_text")


def test_extract_text_plug_point(spark):
    files = spark.createDataFrame([("/a", bytearray(b"p1\np2\n")), ("/bad", bytearray(b"\xff"))],
                                  "path string, content binary")
    parse = lambda data: bytes(data).decode("utf-8").split("\n")[:-1]
    pages = D.extract_text(files, parse)
    got = {r.doc_id: (r.text, r.status) for r in D.drop_empty_text(D.concat_pages(pages)).collect()}
    assert got == {"/a": ("p1p2", "ok"), "/bad": ("", "no_text")}


def test_cache_rows_that_repeat_do_not_repeat_documents(spark):
    from quire.functions.text import path_key
    docs = spark.createDataFrame([("/a",), ("/b",)], "file_path string")
    cache = docs.where("file_path = '/a'").select(path_key("file_path").alias("path_md5"), F.lit("t").alias("text"))
    texts, new = D.text_cache_lookup(docs, cache.unionByName(cache), lambda d: d.withColumn("text", F.lit("fresh")))
    assert sorted((r.file_path, r.text, r.from_cache) for r in texts.collect()) == [("/a", "t", True), ("/b", "fresh", False)]
    assert [r.text for r in new.collect()] == ["fresh"]
