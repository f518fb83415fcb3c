"""Hand-off planning tables: blob sync plan, archive manifest, moderation payloads, run statistics.

The side effects of the reference (downloads, copies, HTTP posts) become tables that say what to do; an
executor-side writer can act on them partition by partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import SENTINELS, file_stem, safe_file_name
from quire.operators.results import match_key

# Fixed values that must equal the reference: the payload's entity name and flag defaults.
PAYLOAD_ENTITY = "contract"


def blob_inventory(listing: DataFrame, name: str = "name") -> DataFrame:
    """Blobs whose name ends with ``.pdf`` in any letter case."""
    return listing.where(F.lower(F.col(name)).endswith(".pdf"))


def blob_sync_plan(remote: DataFrame, local: DataFrame, name: str = "name", size: str = "size") -> DataFrame:
    """Per remote PDF: ``skip`` when a local file of the same name has the same size, else ``fetch``."""
    r = blob_inventory(remote, name)
    lo = local.select(F.col(name), F.col(size).alias("local_size"))
    return (r.join(lo, name, "left")
            .withColumn("action", F.when(F.col("local_size") == F.col(size), F.lit("skip")).otherwise(F.lit("fetch"))))


def archive_manifest(records: DataFrame, key: str, seq: str = "seq", path: str = "file_path",
                     archived: DataFrame | None = None) -> DataFrame:
    """Destination ``<sanitized id>.pdf`` per accepted document and an outcome status.

    ``invalid``: id is a sentinel, empty, null, or sanitizes to nothing.  ``exists``: the destination is
    already archived or an earlier row (by ``seq``) claims it.  ``copied``: first writer of a destination.
    First writers come from a ``min`` per destination (partial aggregation, no window on a hot key)."""
    safe = safe_file_name(F.col(key))
    base = records.select(seq, key, path).withColumn(
        "dest", F.when(F.col(key).isNull() | F.col(key).isin(*SENTINELS, "") | (safe == ""), F.lit(None))
        .otherwise(F.concat(safe, F.lit(".pdf"))))
    base = base.withColumn("_own", match_key(F.col("dest"), F.col("dest").isNotNull(), seq))
    first = base.where(F.col("dest").isNotNull()).groupBy("_own").agg(F.min(seq).alias("_first"))
    out = base.join(first, "_own", "left")
    taken = F.lit(False)
    if archived is not None:
        out = out.join(archived.select(F.col("dest").alias("_own")).distinct().withColumn("_archived", F.lit(True)), "_own", "left")
        taken = F.coalesce(F.col("_archived"), F.lit(False))
    status = (F.when(F.col("dest").isNull(), F.lit("invalid"))
              .when(taken | (F.col(seq) != F.col("_first")), F.lit("exists"))
              .otherwise(F.lit("copied")))
    return out.withColumn("status", status).drop("_own", "_first", "_archived")


def moderation_payload(docs: DataFrame, client_id: str, path: str = "path", text: str = "text") -> DataFrame:
    """JSON payload per document: the file stem is name and contract number, placeholders stay null."""
    stem = file_stem(F.col(path))
    body = F.struct(
        F.lit(client_id).alias("clientId"), stem.alias("name"), F.lit(PAYLOAD_ENTITY).alias("entity"),
        F.col(text).alias("content"), F.lit(None).cast("string").alias("vendor_name"),
        F.lit(False).alias("passthrough"), F.lit(None).cast("string").alias("fy25_value"),
        F.lit(None).cast("string").alias("total_value"), F.lit(None).cast("string").alias("contracting_officer"),
        stem.alias("contract_number"))
    return docs.select(path, F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"),
                       F.col(text).isNotNull().alias("has_content"))


def push_summary(payloads: DataFrame, ok: str = "has_content") -> DataFrame:
    """Success / failure counts (documents without text count as failures)."""
    return payloads.agg(F.count_if(F.col(ok)).alias("n_success"), F.count_if(~F.col(ok)).alias("n_failure"))


def elapsed_stats(log: DataFrame, group: str, ts: str = "ts") -> DataFrame:
    """Per run: first/last timestamp span in seconds, item count and seconds per item."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    return (log.groupBy(group)
            .agg((F.max(us) - F.min(us)).alias("elapsed_us"), F.count(F.lit(1)).alias("n_items"))
            .withColumn("elapsed_s", F.col("elapsed_us") / F.lit(1_000_000.0))
            .withColumn("s_per_item", F.col("elapsed_us") / F.col("n_items") / F.lit(1_000_000.0))
            .drop("elapsed_us"))
