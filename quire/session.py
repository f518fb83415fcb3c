"""Session helpers: building a session, the checkpoint folder, size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


# what the library wants where the session's configuration says nothing
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "quire", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """The running session, or a new one.

    Nothing that a cluster's configuration (``spark-submit``, ``spark-defaults.conf``) has set is overridden: the master,
    shuffle partitions and memory are left alone unless passed here (``extra`` takes any other setting)."""
    conf = SparkConf()
    builder = SparkSession.builder.appName(app)
    wanted = {k: v for k, v in DEFAULTS.items() if not conf.contains(k)}
    if master:
        wanted["spark.master"] = master
    if shuffle_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in {**wanted, **(extra or {})}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used as is.  Only when it is
    unset on a local master (tests, laptops) a private folder is created and registered; a cluster without
    the setting is an error, because a machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (iterative operators and scratch "
                           "outputs are written there)")
    local = tempfile.mkdtemp(prefix="quire-ckpt-")
    sc.setCheckpointDir(local)
    return local


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a new folder below the shared checkpoint folder, and read back."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_counted(df: DataFrame, name: str, size: Column | None = None) -> tuple[DataFrame, int]:
    """As ``stored``, with the number of rows (or the sum of ``size``), taken by the write itself."""
    seen = Observation()
    total = F.count(F.lit(1)) if size is None else F.sum(size)
    back = stored(df.observe(seen, F.coalesce(total, F.lit(0)).alias("n")), name)
    return back, int(seen.get["n"])


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that is never broadcast, for a side that grows with the input.

    Left to itself Spark broadcasts a side whose files are under 10 MB; compressed ids take ten times that in memory, and
    the driver holds it."""
    return df.hint("merge")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never a local one."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast hint only behind a checked row bound; beyond it the optimizer picks a shuffle join."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
