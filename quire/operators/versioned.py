"""Result table with versions: an upsert rewrites only the buckets whose rows change, and is seen all at once.

Layout below the table's path::

    data/<commit>/bucket=<b>/...   files of one write, bucketed by a hash of the key
    files/<commit>/                which files make up the table after that write (bucket, file)
    versions/<number>              the commit pointer: a small file, created once, that names a commit

A write adds files under a fresh commit name and creates the next pointer last.  Until then readers see the version
before; a write that fails leaves nothing but files that no version names.  Two writers cannot both create the next
pointer.  Rows with sentinel or null keys are never updated and are spread over all buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.text import is_sentinel
from quire.operators.results import UPSERT_COLUMNS, match_key, upsert_results
from quire.sources.folders import create_new, names, read_text


class WriteConflict(RuntimeError):
    """Another writer has created the version that this write was to become."""


class VersionedTable:
    """A table at ``path`` with the key column ``key``; ``buckets`` is fixed when the table is created.

    The number of buckets bounds what one update has to rewrite: about rows / ``buckets`` for each changed key."""

    def __init__(self, spark: SparkSession, path: str, key: str = "contract_number"):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    # ---- versions

    def versions(self) -> list[int]:
        return [int(n) for n in names(self.spark, f"{self.path}/versions") if n.isdigit()]

    def _pointer(self, version: int) -> tuple[str, int, T.StructType]:
        commit, buckets, schema = read_text(self.spark, f"{self.path}/versions/{version:012d}").split("\n", 2)
        return commit, int(buckets), T.StructType.fromDDL(schema)

    def _latest(self) -> int:
        found = self.versions()
        if not found:
            raise FileNotFoundError(f"no version of a table at {self.path}")
        return found[-1]

    def files(self, version: int | None = None) -> DataFrame:
        """(bucket, file): the files of a version (by default the latest), relative to the table's path."""
        commit, _, _ = self._pointer(self._latest() if version is None else version)
        return self.spark.read.schema("bucket int, file string").parquet(f"{self.path}/files/{commit}")

    def read(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The rows of a version, or of some of its buckets."""
        _, _, schema = self._pointer(self._latest() if version is None else version)
        files = self.files(version)
        if buckets is not None:
            files = files.where(F.col("bucket").isin(buckets))
        paths = [f"{self.path}/{r.file}" for r in files.select("file").toLocalIterator()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    # ---- writes

    def _bucket(self, df: DataFrame, buckets: int) -> Column:
        valid = F.col(self.key).isNotNull() & ~is_sentinel(self.key)
        return F.pmod(F.xxhash64(match_key(F.col(self.key), valid, *df.columns)), F.lit(buckets)).cast("int")

    def _write(self, rows: DataFrame, buckets: int, kept: DataFrame | None, version: int) -> int:
        """Adds the files of ``rows``, and makes them and the files ``kept`` the given version."""
        commit = uuid.uuid4().hex
        out = f"{self.path}/data/{commit}"
        # about one file for each bucket; a large bucket is split by the size that Spark measures
        placed = rows.withColumn("bucket", self._bucket(rows, buckets)).hint("rebalance", "bucket")
        placed.write.partitionBy("bucket").parquet(out)
        table = T.StructType([*rows.schema.fields, T.StructField("bucket", T.IntegerType())])
        added = self.spark.read.schema(table).option("basePath", out).parquet(out).select(
            "bucket", F.regexp_extract(F.col("_metadata.file_path"), r"(data/[^/]+/bucket=[^/]+/[^/]+)$", 1).alias("file")).distinct()
        listed = added if kept is None else added.unionByName(kept)
        listed.coalesce(1).write.parquet(f"{self.path}/files/{commit}")
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        if not create_new(self.spark, f"{self.path}/versions/{version:012d}", f"{commit}\n{buckets}\n{ddl}"):
            raise WriteConflict(f"version {version} of {self.path} was written meanwhile")
        return version

    def create(self, rows: DataFrame, buckets: int = 64) -> int:
        """The first version, from ``rows``."""
        return self._write(rows, buckets, None, 1)

    def upsert(self, updates: DataFrame, seq: str = "useq", columns: list[str] = UPSERT_COLUMNS, base: int | None = None) -> int:
        """The next version: ``columns`` of every row with an updated key, by ``results.upsert_results``; returns its
        number, or the old one if no key of the table is updated.  ``base`` is the version the update was made for; if
        another one has come meanwhile, ``WriteConflict`` is raised.

        Buckets that may hold an updated key are searched for the keys alone; only those with a hit are rewritten."""
        version = self._latest() if base is None else base
        _, buckets, _ = self._pointer(version)
        valid = updates.where(F.col(self.key).isNotNull() & ~is_sentinel(self.key))
        wanted = valid.select(self.key).distinct()
        may = [r[0] for r in wanted.select(self._bucket(wanted, buckets)).distinct().collect()]  # at most ``buckets``
        found = self.read(version, may).select(self.key).join(wanted, self.key, "left_semi")
        hit = [r[0] for r in found.select(self._bucket(found, buckets)).distinct().collect()]
        if not hit:
            return version
        rows = upsert_results(self.read(version, hit), updates, self.key, seq, columns)
        return self._write(rows, buckets, self.files(version).where(~F.col("bucket").isin(hit)), version + 1)
