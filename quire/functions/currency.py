"""Money text to numbers and back, as native column expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference: the sentinel treated as zero, the unit word, and the
# thresholds / suffixes of the money formatter (billions, millions, thousands).
NOT_FOUND = "Not found"
MILLION_WORD = "million"
UNIT_STEPS = [(1_000_000_000, "B"), (1_000_000, "M"), (1_000, "K")]

# Python float() syntax subset accepted on the "million" branch (sign and exponent allowed).
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def col_of(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def idiv(a, b) -> Column:
    """Integral division (SQL ``a div b``), exact on BIGINT."""
    return F.call_function("div", col_of(a), b if isinstance(b, Column) else F.lit(b))


# Whitespace as Python's ``str.strip`` sees it (the reference strips money text and ids that way): every
# character whose ``isspace()`` is true, derived by rule rather than listed (all lie below U+3001).
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip_ws(c) -> Column:
    """Whitespace strip on both ends (Spark ``trim`` alone removes only blanks)."""
    return F.trim(col_of(c), F.lit(WHITESPACE))


def _number(text: Column, scale: float = 1.0) -> Column:
    return F.coalesce(text.try_cast("double") * F.lit(scale), F.lit(0.0))


def _clean(s: Column) -> Column:
    """``s`` is the lower-cased text without ``usd`` / ``$``, stripped.  Digits and dots that are no number (none, or
    more than one dot) give 0, except that the plain branch keeps the first dot only."""
    head = F.replace(strip_ws(F.split_part(s, F.lit(MILLION_WORD), F.lit(1))), F.lit(","), F.lit(""))
    short = F.regexp_replace(F.substring(s, F.lit(1), F.length(s) - 1), "[^0-9.]", "")
    digits = F.regexp_replace(s, "[^0-9.]", "")
    plain = F.concat(F.regexp_extract(digits, r"^[0-9]*\.?", 0),
                     F.replace(F.regexp_extract(digits, r"^[0-9]*\.?(.*)$", 1), F.lit("."), F.lit("")))
    return (F.when(F.instr(s, MILLION_WORD) > 0, _number(F.regexp_extract(head, _NUMBER, 0), 1_000_000.0))
            .when(F.endswith(s, F.lit("m")), _number(short, 1_000_000.0))
            .otherwise(_number(plain)))


def clean_currency(x) -> Column:
    """Messy money text -> DOUBLE.

    ``'$1,234.5'`` -> 1234.5; ``'2.5 million'`` -> 2500000; ``'3M'`` -> 3000000; null / ``'Not found'`` / no digits -> 0.
    Only the ``million`` branch keeps a sign; the other branches drop every character but digits and dots, and
    keep the first dot only.  Unparseable text gives 0.
    """
    raw = col_of(x)
    s = strip_ws(F.replace(F.replace(strip_ws(F.lower(raw)), F.lit("usd"), F.lit("")), F.lit("$"), F.lit("")))
    return (F.when(raw.isNull() | (raw == F.lit(NOT_FOUND)), F.lit(0.0))
            .otherwise(_clean(s)))


def money(x) -> Column:
    """Amount as DECIMAL(28,2): sums become exact and independent of row order.

    An amount of 1e26 or more (or infinite) is no amount of money and counts as 0, like text without a number."""
    return F.coalesce(col_of(x).try_cast("decimal(28,2)"), F.when(col_of(x).isNotNull(), F.lit(0)).cast("decimal(28,2)"))


def to_cents(x) -> Column:
    """Exact cents of an amount as DECIMAL(38,0); null if the amount has no cents of that size."""
    return (col_of(x).try_cast("decimal(36,2)") * F.lit(100)).try_cast("decimal(38,0)")


def format_currency(x) -> Column:
    """Amount -> ``$1.23B`` / ``$4.56M`` / ``$7.89K`` / ``$12.34``; negatives fall to the plain branch.

    The unit is chosen by the amount as it is, before rounding, so 999,999.999 is ``$1000.00K``.  Two decimals, no
    thousands separators.  Rounding is half-up on exact decimals (the reference rounds binary doubles, so the two
    differ only on exact ties).
    """
    amount = col_of(x).try_cast("decimal(36,9)")
    text = F.concat(F.lit("$"), F.round(amount, 2).cast("decimal(36,2)").cast("string"))
    for step, suffix in reversed(UNIT_STEPS):
        scaled = F.round(amount / F.lit(step).cast("decimal(10,0)"), 2).cast("decimal(36,2)")
        text = F.when(amount >= step, F.concat(F.lit("$"), scaled.cast("string"), F.lit(suffix))).otherwise(text)
    return text


def pad_right(x, width: int) -> Column:
    """Left-justify to ``width``; longer text is kept whole (``rpad`` would cut it)."""
    c = col_of(x)
    return F.when(F.length(c) < width, F.rpad(c, width, " ")).otherwise(c)


def pad_left(x, width: int) -> Column:
    """Right-justify to ``width``; longer text is kept whole."""
    c = col_of(x)
    return F.when(F.length(c) < width, F.lpad(c, width, " ")).otherwise(c)


def report_line(rank, vendor, total_text, fy_text) -> Column:
    """Rank left 4, vendor cut to 50 and left 50, both values right 15, one blank between columns."""
    return F.concat_ws(
        " ",
        pad_right(col_of(rank).cast("string"), 4),
        pad_right(F.substring(col_of(vendor), 1, 50), 50),
        pad_left(total_text, 15),
        pad_left(fy_text, 15),
    )
