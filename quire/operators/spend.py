"""Spend analytics: cleaned money, parent-aware totals, vendor roll-up, top-k, text report.

All aggregates are decomposable (sum / count / min_by), so Spark combines map-side before the shuffle and a
hot key (one parent or vendor holding a third of all rows) costs one partial row per task, not a skewed task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.currency import clean_currency, format_currency, money, report_line

# Fixed values that must equal the reference's report: the parent of standalone rows, the width of rules, the columns
# (heading, width, side), the titles of file and sections, the labels of the summary lines.
STANDALONE = "Not found"
RULE_WIDTH = 85
REPORT_COLUMNS = [("Rank", 4, "left"), ("Vendor", 50, "left"), ("Total Value", 15, "right"), ("FY25", 15, "right")]
FILE_TITLE = "Contract Analysis Report - Generated on "
SECTION_TITLES = ("All Contracts", "Munchable Contracts Only")
TOTAL_LABEL, FY_LABEL, COUNT_LABEL = "Total Contract Value: ", "Total FY25 Value: ", "Number of Unique Contracts: "


def top_title(n: int) -> str:
    return f"Top {n} Vendors by Contract Value:"


def header_line() -> str:
    return " ".join(name.ljust(width) if side == "left" else name.rjust(width) for name, width, side in REPORT_COLUMNS)


def with_clean_money(df: DataFrame, cols=("total_value", "fy25_value")) -> DataFrame:
    """Replace money text columns with cleaned DECIMAL(28,2) amounts."""
    return df.withColumns({c: money(clean_currency(c)) for c in cols})


def is_standalone(parent="parent_contract_number"):
    p = F.col(parent)
    return p.isNull() | (p == F.lit("")) | (p == F.lit(STANDALONE))


def spend_totals(df: DataFrame, seq: str = "seq", parent: str = "parent_contract_number") -> DataFrame:
    """One row: total and FY value counting every standalone row and only the first row (by ``seq``) of each
    parent group; ``n_contracts`` = distinct parents + standalone rows.  Input money must be cleaned."""
    alone = is_standalone(parent)
    firsts = (df.where(~alone)
              .groupBy(parent)
              .agg(F.min_by(F.struct("total_value", "fy25_value"), F.col(seq)).alias("v"))
              .select(F.col("v.total_value").alias("t"), F.col("v.fy25_value").alias("f"), F.lit(1).alias("is_child")))
    singles = df.where(alone).select(F.col("total_value").alias("t"), F.col("fy25_value").alias("f"),
                                     F.lit(0).alias("is_child"))
    return firsts.unionByName(singles).agg(
        F.coalesce(F.sum("t"), F.lit(0)).cast("decimal(38,2)").alias("total_value"),
        F.coalesce(F.sum("f"), F.lit(0)).cast("decimal(38,2)").alias("fy25_value"),
        F.count(F.lit(1)).alias("n_contracts"),
    )


def unique_contract_count(df: DataFrame, parent: str = "parent_contract_number") -> DataFrame:
    alone = is_standalone(parent)
    return df.agg(
        (F.countDistinct(F.when(~alone, F.col(parent))) + F.count_if(alone)).alias("n_contracts"))


def vendor_totals(df: DataFrame, vendor: str = "vendor_name") -> DataFrame:
    """Sum of both amounts per vendor over all rows; null vendor dropped."""
    return (df.where(F.col(vendor).isNotNull())
            .groupBy(vendor)
            .agg(F.sum("total_value").cast("decimal(38,2)").alias("total_value"),
                 F.sum("fy25_value").cast("decimal(38,2)").alias("fy25_value")))


def top_vendors(df: DataFrame, n: int = 100, vendor: str = "vendor_name") -> DataFrame:
    """Top ``n`` vendors by total, ranked 1..n (ties broken by name).  ``orderBy + limit`` plans as
    TakeOrderedAndProject (per-task top-n, then one merge of n * tasks rows); the rank window only ever
    sees those ``n`` rows."""
    top = vendor_totals(df, vendor).orderBy(F.col("total_value").desc(), F.col(vendor).asc()).limit(n)
    w = Window.orderBy(F.col("total_value").desc(), F.col(vendor).asc())
    return top.withColumn("vendor_rank", F.row_number().over(w))


def status_subset(df: DataFrame, status: str = "second_pass_munchable", value: str = "true") -> DataFrame:
    """Rows whose status column equals ``value`` ignoring case (status is a parameter: the reference's column
    name is never produced by its own pipeline)."""
    return df.where(F.lower(F.col(status)) == F.lit(value.lower()))


def _both_totals(df: DataFrame, sub: Column, seq: str = "seq", parent: str = "parent_contract_number") -> DataFrame:
    """``spend_totals`` for all rows (``a_*``) and for the subset (``s_*``) in one aggregation: the subset's
    first child per parent is ``min_by`` over an ordering that is null outside the subset (nulls are skipped)."""
    alone = is_standalone(parent)
    pair = F.struct("total_value", "fy25_value")
    firsts = (df.where(~alone).groupBy(parent)
              .agg(F.min_by(pair, F.col(seq)).alias("a"), F.min_by(pair, F.when(sub, F.col(seq))).alias("s"))
              .select(F.col("a.total_value").alias("a_t"), F.col("a.fy25_value").alias("a_f"),
                      F.col("s.total_value").alias("s_t"), F.col("s.fy25_value").alias("s_f"),
                      F.col("s").isNotNull().alias("s_n")))
    singles = df.where(alone).select(
        F.col("total_value").alias("a_t"), F.col("fy25_value").alias("a_f"),
        F.when(sub, F.col("total_value")).alias("s_t"), F.when(sub, F.col("fy25_value")).alias("s_f"),
        sub.alias("s_n"))
    return firsts.unionByName(singles).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,2)").alias(c) for c in ("a_t", "a_f", "s_t", "s_f")],
        F.count(F.lit(1)).alias("a_n"), F.count_if("s_n").alias("s_n"))


def _vendor_lines(df: DataFrame, sub: Column, n: int, vendor: str = "vendor_name") -> DataFrame:
    """Ranked vendor lines of both sections from one vendor aggregation.

    Each vendor yields a row for section 1 and, if it has subset rows, one for section 2; ``row_number() <= n``
    per section plans a partial WindowGroupLimit before the shuffle, so only ``n`` rows per section per task
    move, however many vendors there are."""
    v = (df.where(F.col(vendor).isNotNull()).groupBy(vendor)
         .agg(F.sum("total_value").alias("a_t"), F.sum("fy25_value").alias("a_f"),
              F.sum(F.when(sub, F.col("total_value"))).alias("s_t"),
              F.sum(F.when(sub, F.col("fy25_value"))).alias("s_f"), F.max(sub).alias("any_s")))
    rows = v.select(vendor, F.inline(F.array(
        F.struct(F.lit(1).alias("section"), F.col("a_t").cast("decimal(38,2)").alias("total_value"),
                 F.col("a_f").cast("decimal(38,2)").alias("fy25_value"), F.lit(True).alias("keep")),
        F.struct(F.lit(2).alias("section"), F.col("s_t").cast("decimal(38,2)").alias("total_value"),
                 F.col("s_f").cast("decimal(38,2)").alias("fy25_value"), F.col("any_s").alias("keep")))))
    w = Window.partitionBy("section").orderBy(F.col("total_value").desc(), F.col(vendor).asc())
    ranked = rows.where("keep").withColumn("vendor_rank", F.row_number().over(w)).where(F.col("vendor_rank") <= n)
    return ranked.select(
        "section", (F.col("vendor_rank") + F.lit(10)).cast("int").alias("line_no"),
        report_line("vendor_rank", vendor, format_currency("total_value"), format_currency("fy25_value")).alias("line"))


def _total_lines(both: DataFrame) -> DataFrame:
    """The three summary lines of both sections from the single totals row."""
    def lines(section: int, t: str, f: str, cnt: str):
        return [
            F.struct(F.lit(section).alias("section"), F.lit(3).alias("line_no"),
                     F.concat(F.lit(TOTAL_LABEL), format_currency(t)).alias("line")),
            F.struct(F.lit(section).alias("section"), F.lit(4).alias("line_no"),
                     F.concat(F.lit(FY_LABEL), format_currency(f)).alias("line")),
            F.struct(F.lit(section).alias("section"), F.lit(5).alias("line_no"),
                     F.concat(F.lit(COUNT_LABEL), F.col(cnt).cast("string")).alias("line")),
        ]
    return both.select(F.inline(F.array(*lines(1, "a_t", "a_f", "a_n"), *lines(2, "s_t", "s_f", "s_n"))))


def _fixed_lines(spark, n: int, run_ts: str, titles: tuple[str, str]) -> DataFrame:
    rows = [(0, 0, FILE_TITLE + run_ts), (0, 1, "=" * RULE_WIDTH), (0, 2, "")]
    for section, title in enumerate(titles, 1):
        rows += [(section, 0, ""), (section, 1, title), (section, 2, "=" * RULE_WIDTH), (section, 6, ""),
                 (section, 7, top_title(n)), (section, 8, "-" * RULE_WIDTH),
                 (section, 9, header_line()),
                 (section, 10, "-" * RULE_WIDTH)]
    return spark.createDataFrame(rows, "section int, line_no int, line string")


def spend_report(df: DataFrame, run_ts: str, subset_status: str = "second_pass_munchable", n: int = 100,
                 subset_value: str = "true", titles: tuple[str, str] = SECTION_TITLES) -> DataFrame:
    """The full text report as ordered lines ``(section, line_no, line)``: file head, all contracts, status subset.

    ``df`` carries cleaned money.  Both sections come from one totals aggregation and one vendor aggregation
    (conditional aggregates for the subset), each referenced once, so the input is scanned three times
    (children, standalone rows, vendors) whatever the number of sections.  Write with ``write_report`` —
    the report is bounded (about 2 * (n + 11) lines) whatever the input size.
    """
    sub = F.coalesce(F.lower(F.col(subset_status)) == F.lit(subset_value.lower()), F.lit(False))
    return (_fixed_lines(df.sparkSession, n, run_ts, titles)
            .unionByName(_total_lines(_both_totals(df, sub)))
            .unionByName(_vendor_lines(df, sub, n)))


def write_report(report: DataFrame, path: str) -> None:
    report.orderBy("section", "line_no").select("line").coalesce(1).write.mode("overwrite").text(path)
