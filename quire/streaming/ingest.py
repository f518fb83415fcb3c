"""Incremental ingest as Structured Streaming: new files only, progress persisted per micro-batch.

``readStream`` over the landing folder (the stream checkpoint remembers which files were seen), then
``foreachBatch``: anti-join the processed ledger, run the user's transformation, and write results and
ledger rows into ``batch_id`` partitions with dynamic partition overwrite.  A batch that is replayed after
a failure rewrites exactly its own partitions, so the sink is idempotent (exactly-once end to end).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The ledger, empty if its folder is not there yet; any other failure to read it is an error."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def process_batch(batch: DataFrame, batch_id: int, results_dir: str, ledger_dir: str,
                  process: Callable[[DataFrame], DataFrame], key: str = "path",
                  status: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """One micro-batch: anti-join the ledger of *earlier* batches, transform, and overwrite this batch's
    ``batch_id`` partitions of results and ledger.  Running it again for the same ``batch_id`` (a replay
    after a failure) rewrites the same partitions, so nothing is duplicated or lost.

    Ledger rows with status ``retry`` do not count as done.  A key that a batch holds twice is processed once.  Of the
    ledger only key and status of done rows are read."""
    spark = batch.sparkSession
    ledger = _read_or_empty(spark, ledger_dir, f"`{key}` string, status string, batch_id long")
    done = ledger.where((F.col("batch_id") < F.lit(batch_id)) & ~F.col("status").eqNullSafe("retry")).select(key)
    fresh = batch.dropDuplicates([key]).join(done, key, "left_anti").persist()
    out = process(fresh).withColumn("batch_id", F.lit(batch_id).cast("long"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(results_dir))
    marks = status(fresh) if status is not None else fresh.select(key, F.lit("ok").alias("status"))
    (marks.select(key, "status").withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
     .parquet(ledger_dir))
    fresh.unpersist()


def incremental_ingest(spark: SparkSession, source_dir: str, schema: T.StructType, results_dir: str,
                       ledger_dir: str, checkpoint: str, process: Callable[[DataFrame], DataFrame],
                       key: str = "path", status: Callable[[DataFrame], DataFrame] | None = None,
                       files_per_batch: int = 1000) -> None:
    """Process every not-yet-processed row of the parquet files landing in ``source_dir``; returns when all
    available files are done (``availableNow``).

    ``process(df) -> df`` builds result rows (it must keep ``key``); ``status(df)`` (optional) gives the
    ledger status per key, default ``ok``."""
    q = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source_dir)
         .writeStream
         .foreachBatch(lambda batch, batch_id: process_batch(batch, batch_id, results_dir, ledger_dir, process,
                                                             key, status))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ATTEMPT = "attempt"


def keyed_batch(batch: DataFrame, batch_id: int, results_dir: str, ledger_dir: str, retry_dir: str,
                process: Callable[[DataFrame], DataFrame], key: str, status: Column) -> None:
    """One micro-batch of ``keyed_ingest``: results of the rows that are done, a ledger row for each, and the rows marked
    ``retry`` once more, as their next attempt; each into the batch's own partition."""
    rows = batch.withColumn("_status", F.coalesce(status, F.lit("ok"))).persist()

    def put(df: DataFrame, path: str) -> None:
        (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))

    again = F.col("_status") == "retry"
    put(process(rows.where(~again).drop("_status", ATTEMPT)), results_dir)
    put(rows.where(again).drop("_status").withColumn(ATTEMPT, F.col(ATTEMPT) + 1), retry_dir)
    put(rows.select(key, F.col("_status").alias("status"), ATTEMPT), ledger_dir)
    rows.unpersist()


def keyed_ingest(spark: SparkSession, source_dir: str, schema: T.StructType, results_dir: str, ledger_dir: str,
                 retry_dir: str, checkpoint: str, process: Callable[[DataFrame], DataFrame], key: str = "path",
                 status: Column | None = None, files_per_batch: int = 1000) -> None:
    """As ``incremental_ingest``, but what has been seen is keyed state of the stream, not a ledger that every batch
    reads: the cost of a batch does not grow with the history.

    A key is processed once, however often it lands; its state is kept by the RocksDB state store below ``checkpoint``.
    ``status`` is a column over the source's columns and ``attempt`` (0 at first); null means ``ok``.  A row for which it
    is ``retry`` has no result yet and is queued in ``retry_dir`` as the key's next attempt, which the next run takes
    up: that is what opens a key again.  A batch that is replayed after a failure rewrites its own partitions, and what it
    queues twice is dropped by the state.  The number of shuffle partitions at the first run stays with the checkpoint."""
    queued = T.StructType([*schema.fields, T.StructField(ATTEMPT, T.IntegerType())])
    spark.createDataFrame([], queued).write.mode("append").parquet(f"{retry_dir.rstrip('/')}/batch_id=-1")  # the folder

    def stream(folder: str, of: T.StructType) -> DataFrame:
        return (spark.readStream.schema(of).option("maxFilesPerTrigger", files_per_batch)
                .option("recursiveFileLookup", True).parquet(folder))

    landed = stream(source_dir, schema).withColumn(ATTEMPT, F.lit(0)).unionByName(stream(retry_dir, queued))
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)  # taken when the query starts
    try:
        q = (landed.dropDuplicates([key, ATTEMPT]).writeStream
             .foreachBatch(lambda batch, batch_id: keyed_batch(batch, batch_id, results_dir, ledger_dir, retry_dir, process, key,
                                                               F.lit("ok") if status is None else status))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set(STATE_STORE, before) if before else spark.conf.unset(STATE_STORE)
