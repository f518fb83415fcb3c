"""File sources and sinks: document listings, result CSVs, ledgers.

Listings use the ``binaryFile`` source with only ``path, length, modificationTime`` selected, so file
contents are never read.  Ledgers are Parquet in steady state; the JSON-array ledger format is read and
written one array per partition, so no single task or the driver ever holds the whole ledger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.text import list_to_text, text_to_list


ARRAY_ROWS = 10_000
CSV_ROWS = 100_000  # rows of one CSV file; a file with quoted line breaks is read by one task


def _existing(spark: SparkSession, roots: list[str], glob: str) -> list[str]:
    """Roots that exist (a missing folder is skipped, as the reference only warns)."""
    from pyspark.errors import AnalysisException

    out = []
    for r in roots:
        try:
            spark.read.format("binaryFile").option("pathGlobFilter", glob).load(r).schema
            out.append(r)
        except AnalysisException:
            continue
    return out


def scan_documents(spark: SparkSession, roots: str | list[str], recursive: bool = True,
                   glob: str = "*.pdf") -> DataFrame:
    """``(path, length, modificationTime)`` of every file matching ``glob`` below the roots.

    All roots are listed in one load; only if one of them is missing are they checked one by one (the
    reference warns about a missing folder and goes on)."""
    from pyspark.errors import AnalysisException

    roots = [roots] if isinstance(roots, str) else list(roots)
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    try:
        return reader.load(roots).select("path", "length", "modificationTime")
    except AnalysisException:
        found = _existing(spark, roots, glob)
    if not found:
        return spark.createDataFrame([], "path string, length long, modificationTime timestamp")
    return reader.load(found).select("path", "length", "modificationTime")


def scan_results_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Result CSV with header under a declared schema (no type inference: ``true``/``n/a`` stay text).

    Empty text cells read back as null, as in the reference's CSV round trip; the declared schema keeps
    ``true`` / ``n/a`` as text (no boolean or NaN drift).  Columns that are lists of strings are read from the text that
    ``write_results_csv`` makes of them."""
    lists = [f.name for f in schema.fields if isinstance(f.dataType, T.ArrayType)]
    flat = T.StructType([T.StructField(f.name, T.StringType()) if f.name in lists else f for f in schema.fields])
    rows = (spark.read.schema(flat).option("header", True).option("multiLine", True).option("escape", '"').csv(path))
    return rows.withColumns({c: text_to_list(f"`{c}`") for c in lists}) if lists else rows


def write_results_csv(df: DataFrame, path: str) -> None:
    """Result rows as header CSV of at most ``CSV_ROWS`` rows a file; a list of strings is one cell of JSON text."""
    lists = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    df = df.withColumns({c: list_to_text(f"`{c}`") for c in lists}) if lists else df
    (df.write.mode("overwrite").option("header", True).option("escape", '"').option("maxRecordsPerFile", CSV_ROWS)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_processed_log(paths: DataFrame, out: str, path: str = "path", fmt: str = "parquet") -> None:
    """Append processed paths to the ledger.  ``fmt='json-array'`` writes JSON arrays of at most ``ARRAY_ROWS`` paths,
    one per line."""
    if fmt == "parquet":
        paths.write.mode("append").parquet(out)
        return
    row = F.monotonically_increasing_id()  # partition in the high bits, row in the partition in the low 33
    arrays = (paths.select(path).withColumn("_part", F.shiftright(row, 33))
              .withColumn("_block", F.floor(row.bitwiseAND((1 << 33) - 1) / ARRAY_ROWS))
              .groupBy("_part", "_block").agg(F.to_json(F.collect_list(path)).alias("value")).select("value"))
    arrays.write.mode("append").text(out)


def load_ledger(spark: SparkSession, path: str, fmt: str = "json-array", key: str = "path") -> DataFrame:
    """Processed paths from JSON-array files (one array per line) or a Parquet / CSV ledger."""
    if fmt == "json-array":
        raw = spark.read.text(path)
        return raw.select(F.explode(F.from_json("value", "array<string>")).alias(key))
    if fmt == "csv":
        df = spark.read.option("header", True).csv(path)
        if key not in df.columns:
            return spark.createDataFrame([], f"`{key}` string")
        return df.select(key).distinct()
    return spark.read.parquet(path)
