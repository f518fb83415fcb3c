"""Small driver-side file operations on whatever store the paths name: listing a folder, files that are created once."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext._jsc
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(sc.hadoopConfiguration()), place


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, place = _store(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file; false, and nothing is changed, if it is there already."""
    fs, place = _store(spark, path)
    try:
        out = fs.create(place, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, place = _store(spark, path)
    source = fs.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
