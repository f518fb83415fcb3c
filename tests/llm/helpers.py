"""Small tables for the corpus operators and plain-Python counterparts to hold them against."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# extra columns with names that the operators use inside
CLASH = ("key", "row", "h", "size", "score", "x", "n", "rest", "digit", "copies", "taken", "predicted", "margin", "rank")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lower(text: str) -> str:
    return text.translate({a: a + 32 for a in range(65, 91)})


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def edited(text: str, seed: int, edits: int) -> str:
    r = random.Random(seed)
    w = text.split(" ")
    for i in r.sample(range(len(w)), edits):
        w[i] = f"e{seed}x{i}"
    return " ".join(w)


def frame(spark, texts, sources=None):
    rows = [(i, t, "en", sources[i] if sources else f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def hard_texts() -> list[str | None]:
    """Nulls, empty and blank texts, a very long text, copies, near copies, odd characters."""
    base = prose(1, 300)
    return [None, "", "  \n\t ", "one", "two words", "A b\x0bC", base, base, base + " ", edited(base, 2, 1), edited(base, 3, 2),
            prose(4, 30_000, 5000), "é ü ÄÖ ä\u00a0b 漢字 \U0001f600", "<|endoftext|> x", prose(5, 60), prose(5, 60), *[prose(i, 80) for i in range(10, 30)]]


def with_clash(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash").cast("string") for c in CLASH}).select(
        *df.columns, *[F.nullif(F.col(c), F.lit("")).alias(c) for c in CLASH])  # nullable


def with_odd_rows(df):
    """A repeated row and rows with nulls in every column."""
    return df.unionByName(df.where("doc_id = 6")).unionByName(df.sparkSession.createDataFrame([(None,) * len(df.columns)], df.schema))
