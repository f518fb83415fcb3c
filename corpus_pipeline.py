"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

toxicity -> exact copies -> near copies -> source mix -> packing.  Every stage works on all rows that its
predecessor kept; the first four return the columns of ``documents`` (a document that the mix takes twice is two
rows), the last one the pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import mixing, packing, radix, set_join, toxicity
from quire.llm.queries import MIX_COPIES, MIX_SHARE, MIX_WEIGHTS, TOXIC_TRAIN
from quire.llm.store import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer does not call toxic; it learns from labelled documents of the stage's input."""
    scorer = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), TOXIC_TRAIN)
    return scorer.score(docs).where("predicted = 0").select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, the one with the largest id."""
    return radix.exact_groups(docs, carry=docs.columns).where("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similar five-word shingles (0.8 or more), the one with the least id."""
    return set_join.drop_similar(docs, set_join.Similarity())


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    mixed = mixing.mix_sources(docs, MIX_WEIGHTS, MIX_SHARE, MIX_COPIES, carry=docs.columns).where("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("source_mix", mix),
    ("packing", pack),
]
ORACLE_SQL = None  # learned scores, random order and token ids: tested against brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
