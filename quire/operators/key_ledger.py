"""Ledger of keys that is searched where a key may be: hashed buckets per batch, each with a Bloom filter beside it.

Layout below the ledger's path::

    keys/batch=<id>/bucket=<b>/      the keys of one batch
    filters/batch=<id>/bucket=<b>/   one Bloom filter for them

A look-up hashes its keys to buckets, reads the filters of those buckets and then only the (batch, bucket) folders for
which a filter lets a key pass; the keys there decide.  A filter never denies a key that it holds, so nothing is
dropped falsely, and a batch of new keys reads next to no keys of the past.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS_PER_KEY, PROBES = 12, 6


def _places(h1: np.ndarray, h2: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each key in a filter of ``bits`` bits, one row per probe."""
    with np.errstate(over="ignore"):
        steps = np.arange(PROBES, dtype=np.uint64)[:, None]
        return (h1.astype(np.uint64) + steps * (h2.astype(np.uint64) | np.uint64(1))) % np.uint64(bits)


def _filter_of(part: pd.DataFrame) -> pd.DataFrame:
    bits = max(64, -(-len(part) * BITS_PER_KEY // 8) * 8)
    flags = np.zeros(bits, bool)
    flags[_places(part["h1"].to_numpy(), part["h2"].to_numpy(), bits).ravel()] = True
    return pd.DataFrame({"bucket": part["bucket"].iloc[:1], "bloom": [np.packbits(flags).tobytes()]})


def _passing(keys: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    """For the keys of one bucket, the batches whose filter lets any of them pass."""
    batches = []
    for batch, bloom in zip(filters["batch"], filters["bloom"], strict=True):
        flags = np.unpackbits(np.frombuffer(bloom, np.uint8)).astype(bool)
        if len(keys) and flags[_places(keys["h1"].to_numpy(), keys["h2"].to_numpy(), len(flags))].all(axis=0).any():
            batches.append(batch)
    return pd.DataFrame({"batch": batches, "bucket": filters["bucket"].iloc[0] if len(filters) else None})


class KeyLedger:
    """Keys (strings) that have been dealt with.  ``buckets`` must be the same for all uses of a ledger; a bucket of one
    batch is held by one task when its filter is made."""

    def __init__(self, spark: SparkSession, path: str, key: str = "path", buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    def _hashed(self, df: DataFrame) -> DataFrame:
        c: Column = F.col(f"`{self.key}`").cast("string")
        h = F.xxhash64(c)
        return df.where(c.isNotNull()).select(c.alias(self.key), F.pmod(h, F.lit(self.buckets)).cast("int").alias("bucket"),
                                              h.alias("h1"), F.xxhash64(c, F.lit("2")).alias("h2")).distinct()

    def _read(self, folder: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(f"{schema}, batch long, bucket int").parquet(f"{self.path}/{folder}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"{schema}, batch long, bucket int")

    def add(self, done: DataFrame, batch: int) -> None:
        """Records the keys of ``done`` as batch ``batch``; writing a batch again replaces it, so a replay after a
        failure leaves every key once.  With a column ``status``, rows marked ``retry`` are left out."""
        if "status" in done.columns:
            done = done.where(~F.col("status").eqNullSafe("retry"))
        keys = self._hashed(done).withColumn("batch", F.lit(batch).cast("long"))

        def put(df: DataFrame, folder: str) -> None:
            (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "bucket")
             .parquet(f"{self.path}/{folder}"))

        put(keys.select(self.key, "batch", "bucket").repartition("bucket"), "keys")
        # filters last: keys without a filter are not looked at, as if the batch had not been
        filters = keys.select("bucket", "h1", "h2").groupBy("bucket").applyInPandas(_filter_of, "bucket int, bloom binary")
        put(filters.withColumn("batch", F.lit(batch).cast("long")), "filters")

    def places(self, keys: DataFrame) -> list[tuple[int, int]]:
        """The (batch, bucket) folders that may hold one of the keys."""
        wanted = self._hashed(keys)
        filters = self._read("filters", "bloom binary").join(F.broadcast(wanted.select("bucket").distinct()), "bucket")
        found = wanted.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(_passing, "batch long, bucket int")
        return sorted((r.batch, r.bucket) for r in found.toLocalIterator())

    def known(self, keys: DataFrame) -> DataFrame:
        """The keys (each once) that the ledger holds."""
        by_batch: dict[int, list[int]] = {}
        for batch, bucket in self.places(keys):
            by_batch.setdefault(batch, []).append(bucket)
        where = F.lit(False)
        for batch, some in by_batch.items():
            where |= (F.col("batch") == batch) & F.col("bucket").isin(some)
        held = self._read("keys", f"`{self.key}` string").where(where).select(self.key)
        return keys.select(F.col(f"`{self.key}`").cast("string").alias(self.key)).distinct().join(held, self.key, "left_semi")

    def unprocessed(self, files: DataFrame) -> DataFrame:
        """The rows whose key the ledger does not hold; a null key is never held."""
        return files.join(self.known(files), self.key, "left_anti")
