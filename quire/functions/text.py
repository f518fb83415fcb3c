"""Small scalar text helpers, all native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.currency import col_of, strip_ws

# Fixed values that must equal the reference: id sentinels, the text budget per request, the error
# text budget, the fallback folder name for a blank group and the placeholder for a missing reason.
SENTINELS = ["Not found", "Error"]
TEXT_BUDGET = 10_000
ERROR_BUDGET = 100
UNKNOWN_GROUP = "unknown_cost_center"
NO_REASON = "No reason provided"


def trim_id(x) -> Column:
    """Whitespace strip of an id (``str.strip``)."""
    return strip_ws(x)


def safe_file_name(x) -> Column:
    """Keep letters, digits and ``._- `` (file names of archived documents)."""
    return F.regexp_replace(col_of(x), r"[^\p{L}\p{N}._\- ]", "")


def safe_dir_name(x) -> Column:
    """Every character that is not a letter or digit becomes ``_``; empty -> the fallback folder name."""
    s = F.regexp_replace(F.coalesce(col_of(x), F.lit("")), r"[^\p{L}\p{N}]", "_")
    return F.when(s == F.lit(""), F.lit(UNKNOWN_GROUP)).otherwise(s)


def path_key(x) -> Column:
    """md5 hex of a path (text-cache key)."""
    return F.md5(col_of(x))


def file_stem(x) -> Column:
    """File name without folder and last extension."""
    name = F.regexp_extract(col_of(x), r"([^/\\]*)$", 1)
    return F.when(F.instr(F.substring(name, 2, 1 << 30), ".") > 0,
                  F.regexp_extract(name, r"^(.+)\.[^.]*$", 1)).otherwise(name)


def truncate_text(x, n: int = TEXT_BUDGET) -> Column:
    """First ``n`` characters (the per-request text budget)."""
    return F.substring(col_of(x), 1, n)


def error_text(x) -> Column:
    """First 100 characters of an error message."""
    return F.substring(col_of(x), 1, ERROR_BUDGET)


def is_blank_reason(x) -> Column:
    c = col_of(x)
    return c.isNull() | c.isin("", "nan")


def normalize_status(status, reason) -> tuple[Column, Column]:
    """Lower-cased status text; a null, empty or ``nan`` reason becomes the placeholder text."""
    st = F.lower(col_of(status).cast("string"))
    rs = F.when(is_blank_reason(reason), F.lit(NO_REASON)).otherwise(col_of(reason))
    return st, rs


def clean_reason(x) -> Column:
    """Null -> '' and a whole-value ``nan`` -> '' (words containing ``nan`` stay intact)."""
    c = col_of(x)
    return F.when(c.isNull() | (c == F.lit("nan")), F.lit("")).otherwise(c)


def list_to_text(x) -> Column:
    """Array of strings -> one JSON text value for CSV export; ``text_to_list`` reads it back."""
    return F.to_json(col_of(x))


def text_to_list(x) -> Column:
    """The array of strings that ``list_to_text`` wrote; other text is a list of that one value, blank text empty."""
    c = col_of(x)
    return (F.when(F.trim(c) == "", F.array().cast("array<string>"))
            .when(F.ltrim(c).startswith("["), F.coalesce(F.from_json(c, "array<string>"), F.array(c)))
            .when(c.isNotNull(), F.array(c)))


def is_sentinel(x) -> Column:
    return col_of(x).isin(*SENTINELS)


def export_name(prefix: str, safe_value, run_ts: str, ext: str = ".csv") -> Column:
    """``<prefix>_<safe value>_<run timestamp><ext>``; the run timestamp is an argument, never ``now()``."""
    return F.concat(F.lit(prefix + "_"), col_of(safe_value), F.lit("_" + run_ts + ext))
