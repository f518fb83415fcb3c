"""Written tables in the session's shared checkpoint folder: they cut lineage and survive lost executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quire.session import checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder named by ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back with its own schema."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
