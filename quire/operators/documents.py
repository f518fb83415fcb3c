"""Document text: page assembly, text cache, empty-text routing, and the plug point for a byte parser.

A document's text is one value assembled from its pages, in two levels (blocks of pages, then blocks per
document) ordered inside the aggregates, so neither a global sort nor one group of all a document's page
rows is needed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.currency import strip_ws
from quire.functions.text import path_key
from quire.session import stored

PAGE_SCHEMA = "doc_id string, page_no int, page_text string, ok boolean"


PAGES_PER_BLOCK = 64


def concat_pages(pages: DataFrame, doc: str = "doc_id", page_no: str = "page_no", text: str = "page_text",
                 ok: str | None = "ok", sep: str = "", strip: bool = False) -> DataFrame:
    """``(doc_id, text)``: page texts in page order.

    Default: failed pages skipped, no separator (the extraction used for analysis).  ``sep='\\n', strip=True``:
    blank pages skipped, separator after every page, whole text stripped, empty text -> null (payload mode).

    Two levels, so a document with a huge page count is not one group of page rows: pages are first joined
    per block of ``PAGES_PER_BLOCK`` consecutive pages, then the (few) block texts per document.
    """
    keep = F.col(ok) if ok else F.lit(True)
    if strip:
        keep = keep & (strip_ws(F.col(text)) != "")

    def ordered_join(order: str, value: str):
        parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("t"))))
        return F.array_join(F.transform(parts, lambda x: x.t), "")

    # Skipped pages become null values (dropped by collect_list), so every document keeps its row: '' when
    # nothing is left in the default mode, null in payload mode.
    blocks = (pages.withColumn("_blk", F.call_function("div", F.col(page_no), F.lit(PAGES_PER_BLOCK)))
              .withColumn("_t", F.when(keep, F.concat(F.col(text), F.lit(sep))))
              .groupBy(doc, "_blk").agg(ordered_join(page_no, "_t").alias("_bt")))
    out = blocks.groupBy(doc).agg(ordered_join("_blk", "_bt").alias("text"))
    if strip:
        out = out.withColumn("text", F.nullif(strip_ws(F.col("text")), F.lit("")))
    return out


def drop_empty_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """Status per document: ``ok`` when it has text, ``no_text`` otherwise (still recorded as processed)."""
    return docs.withColumn("status", F.when(F.coalesce(F.length(text), F.lit(0)) > 0, F.lit("ok"))
                           .otherwise(F.lit("no_text")))


def text_cache_lookup(docs: DataFrame, cache: DataFrame, extract: Callable[[DataFrame], DataFrame],
                      path: str = "file_path", version: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Text for every document: cache hit by ``md5(path)``, else ``extract`` on the misses only.

    ``version`` (e.g. ``["length", "modificationTime"]`` from a binaryFile listing) adds columns to the cache
    key, so a file rewritten in place misses the cache; the default keys on the path alone, as the reference
    does.  Returns ``(texts, new_cache_rows)``; empty texts are never cached.  A key that the cache holds twice
    counts once (its greatest text).  Extracted texts are stored once, and both results read them.  ``extract`` maps a DataFrame with
    the document columns to one with an added ``text`` column (for example a ``mapInPandas`` parser)."""
    keys = ["path_md5", *(version or [])]
    keyed = docs.withColumn("path_md5", path_key(path))
    cached = cache.groupBy(*keys).agg(F.max("text").alias("text"))
    hits = keyed.join(cached, keys, "inner").withColumn("from_cache", F.lit(True))
    misses = stored(extract(keyed.join(cached.select(*keys), keys, "left_anti")).withColumn("from_cache", F.lit(False)), "extracted")
    texts = hits.unionByName(misses)
    new_rows = misses.where(F.coalesce(F.length("text"), F.lit(0)) > 0).select(*keys, "text")
    return texts, new_rows


def extract_text(files: DataFrame, parse_pages: Callable[[bytes], list[str]],
                 path: str = "path", content: str = "content") -> DataFrame:
    """Plug point for a byte-level parser: ``(path, content)`` rows -> page table.

    ``parse_pages`` turns one file's bytes into its page texts; a page the parser could not read is given as
    a non-string item and kept with ``ok=false``; a file that raises yields one failed page, so it still gets
    a (empty) text and a ``no_text`` ledger status.  Runs per Arrow batch inside the tasks that read the files."""
    def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p, data in zip(b[path], b[content]):  # the pages of one file at a time
                try:
                    rows = [(p, i, t if isinstance(t, str) else None, isinstance(t, str)) for i, t in enumerate(parse_pages(data))]
                except Exception:
                    rows = [(p, 0, None, False)]
                yield pd.DataFrame(rows, columns=["doc_id", "page_no", "page_text", "ok"])

    return files.select(path, content).mapInPandas(per_batch, PAGE_SCHEMA)
