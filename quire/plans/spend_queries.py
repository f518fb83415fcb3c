"""Spend analytics queries over the contracts adapter (orders x customer)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.currency import clean_currency, format_currency, money, report_line
from quire.operators import spend
from quire.plans import sql_parts as S
from quire.plans.registry import query
from quire.sources import tables

RUN_TS = "2025-01-01 00:00:00"


def contracts_clean(spark, sf):
    return spend.with_clean_money(tables.contracts(spark, sf))


@query("clean_currency", S.with_ctes(f"""
SELECT contract_number, total_value AS total_text, {S.clean_currency('total_value')} AS total_value,
       fy25_value AS fy25_text, {S.clean_currency('fy25_value')} AS fy25_value
FROM contracts""", "contracts"))
def q_clean_currency(spark, sf):
    c = tables.contracts(spark, sf)
    return c.select("contract_number", F.col("total_value").alias("total_text"),
                    clean_currency("total_value").alias("total_value"),
                    F.col("fy25_value").alias("fy25_text"), clean_currency("fy25_value").alias("fy25_value"))


@query("format_currency", S.with_ctes(f"""
SELECT contract_number, {S.format_currency('total_value')} AS total_fmt, {S.format_currency('fy25_value')} AS fy25_fmt
FROM contracts_clean""", "contracts_clean"))
def q_format_currency(spark, sf):
    c = contracts_clean(spark, sf)
    return c.select("contract_number", format_currency("total_value").alias("total_fmt"),
                    format_currency("fy25_value").alias("fy25_fmt"))


@query("money_odd", """
SELECT o_orderkey AS k, CAST(CASE o_orderkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 999999.99 WHEN 2 THEN 0 WHEN 3 THEN 1000000 ELSE 12.5 END
                             AS DOUBLE) AS amount,
       CASE o_orderkey % 5 WHEN 0 THEN '$0.00' WHEN 1 THEN '$1000.00K' WHEN 2 THEN '$0.00' WHEN 3 THEN '$1.00M' ELSE '$12.50' END AS text,
       CASE o_orderkey % 5 WHEN 3 THEN '$1000.00K' END AS unrounded
FROM orders""", note="amounts too large for money, and the unit at its edge; expected values by hand")
def q_money_odd(spark, sf):
    odd = """case o_orderkey % 5 when 0 then concat('$', repeat('123', 12), o_orderkey) when 1 then '999,999.994'
             when 2 then '9e999 million' when 3 then '999,999.999' else '$12.50' end"""
    rows = tables.load(spark, sf, "orders").selectExpr("o_orderkey as k", f"{odd} as value")
    rows = rows.withColumn("number", clean_currency("value")).withColumn("amount", money("number"))
    return rows.select("k", F.col("amount").cast("double").alias("amount"), format_currency("amount").alias("text"),
                       F.when(F.col("k") % 5 == 3, format_currency("number")).alias("unrounded"))


_SPEND_TOTALS_SQL = """
SELECT CAST(coalesce(sum(t), 0) AS DOUBLE) AS total_value, CAST(coalesce(sum(f), 0) AS DOUBLE) AS fy25_value,
       CAST(count(*) AS BIGINT) AS n_contracts
FROM (
  SELECT arg_min_null(total_value, seq) AS t, arg_min_null(fy25_value, seq) AS f FROM {src}
  WHERE NOT (parent_contract_number IS NULL OR parent_contract_number IN ('', 'Not found'))
  GROUP BY parent_contract_number
  UNION ALL
  SELECT total_value, fy25_value FROM {src}
  WHERE parent_contract_number IS NULL OR parent_contract_number IN ('', 'Not found'))"""


def _as_double(df, *cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


@query("spend_totals", S.with_ctes(_SPEND_TOTALS_SQL.format(src="contracts_clean"), "contracts_clean"))
def q_spend_totals(spark, sf):
    return _as_double(spend.spend_totals(contracts_clean(spark, sf)), "total_value", "fy25_value")


@query("unique_contract_count", S.with_ctes("""
SELECT CAST(count(DISTINCT CASE WHEN NOT (parent_contract_number IS NULL OR parent_contract_number IN ('', 'Not found'))
                                THEN parent_contract_number END)
            + count(*) FILTER (WHERE parent_contract_number IS NULL OR parent_contract_number IN ('', 'Not found'))
            AS BIGINT) AS n_contracts
FROM contracts""", "contracts"))
def q_unique_contract_count(spark, sf):
    return spend.unique_contract_count(tables.contracts(spark, sf))


@query("vendor_totals", S.with_ctes("""
SELECT vendor_name, CAST(sum(total_value) AS DOUBLE) AS total_value, CAST(sum(fy25_value) AS DOUBLE) AS fy25_value
FROM contracts_clean WHERE vendor_name IS NOT NULL GROUP BY vendor_name""", "contracts_clean"))
def q_vendor_totals(spark, sf):
    return _as_double(spend.vendor_totals(contracts_clean(spark, sf)), "total_value", "fy25_value")


_TOP_SQL = """
SELECT vendor_name, total_value, fy25_value,
       row_number() OVER (ORDER BY total_value DESC, vendor_name ASC) AS vendor_rank
FROM (SELECT vendor_name, sum(total_value) AS total_value, sum(fy25_value) AS fy25_value
      FROM contracts_clean WHERE vendor_name IS NOT NULL GROUP BY vendor_name
      ORDER BY total_value DESC, vendor_name ASC LIMIT 100) t"""


@query("top_vendors", S.with_ctes(f"""
SELECT vendor_name, CAST(total_value AS DOUBLE) AS total_value, CAST(fy25_value AS DOUBLE) AS fy25_value,
       CAST(vendor_rank AS BIGINT) AS vendor_rank FROM ({_TOP_SQL}) r""", "contracts_clean"))
def q_top_vendors(spark, sf):
    t = spend.top_vendors(contracts_clean(spark, sf), 100)
    return _as_double(t, "total_value", "fy25_value").withColumn("vendor_rank", F.col("vendor_rank").cast("bigint"))


@query("vendor_rank", S.with_ctes(f"""
SELECT CAST(vendor_rank AS BIGINT) AS vendor_rank, vendor_name,
       {S.report_line('vendor_rank', 'vendor_name', S.format_currency('total_value'), S.format_currency('fy25_value'))}
       AS line
FROM ({_TOP_SQL}) r""", "contracts_clean"))
def q_vendor_rank(spark, sf):
    t = spend.top_vendors(contracts_clean(spark, sf), 100)
    return t.select(F.col("vendor_rank").cast("bigint").alias("vendor_rank"), "vendor_name",
                    report_line("vendor_rank", "vendor_name", format_currency("total_value"),
                                format_currency("fy25_value")).alias("line"))


@query("report_line", S.with_ctes(f"""
SELECT vendor_name,
       {S.report_line("'-'", 'vendor_name', S.format_currency('total_value'), S.format_currency('fy25_value'))} AS line
FROM (SELECT vendor_name, sum(total_value) AS total_value, sum(fy25_value) AS fy25_value
      FROM contracts_clean WHERE vendor_name IS NOT NULL GROUP BY vendor_name) v""", "contracts_clean"))
def q_report_line(spark, sf):
    """Fixed-width line for every vendor (rank column left as '-': a global rank is only built for the top-k)."""
    v = spend.vendor_totals(contracts_clean(spark, sf))
    return v.select("vendor_name", report_line(F.lit("-"), "vendor_name", format_currency("total_value"),
                                               format_currency("fy25_value")).alias("line"))


@query("status_subset", S.with_ctes("""
SELECT contract_number, vendor_name, second_pass_munchable FROM contracts
WHERE lower(second_pass_munchable) = 'true'""", "contracts"))
def q_status_subset(spark, sf):
    return spend.status_subset(tables.contracts(spark, sf)).select(
        "contract_number", "vendor_name", "second_pass_munchable")


def _report_section_sql(src: str, title: str, section: int) -> str:
    tot = _SPEND_TOTALS_SQL.format(src=src).replace("CAST(coalesce(sum(t), 0) AS DOUBLE)", "coalesce(sum(t), 0)") \
        .replace("CAST(coalesce(sum(f), 0) AS DOUBLE)", "coalesce(sum(f), 0)")
    top = _TOP_SQL.replace("contracts_clean", src)
    line = S.report_line('vendor_rank', 'vendor_name', S.format_currency('total_value'), S.format_currency('fy25_value'))
    hdr = spend.header_line()
    return f"""
SELECT {section} AS section, line_no, line FROM (
  SELECT * FROM (VALUES (0, ''), (1, '{title}'), (2, '{"=" * 85}'), (6, ''),
                        (7, 'Top 100 Vendors by Contract Value:'), (8, '{"-" * 85}'), (9, '{hdr}'), (10, '{"-" * 85}'))
         AS h(line_no, line)
  UNION ALL
  SELECT 3, 'Total Contract Value: ' || {S.format_currency('total_value')} FROM ({tot}) s
  UNION ALL
  SELECT 4, 'Total FY25 Value: ' || {S.format_currency('fy25_value')} FROM ({tot}) s
  UNION ALL
  SELECT 5, 'Number of Unique Contracts: ' || n_contracts FROM ({tot}) s
  UNION ALL
  SELECT vendor_rank + 10, {line} FROM ({top}) r) x"""


_SUBSET = """
subset_clean AS (SELECT * FROM contracts_clean WHERE lower(second_pass_munchable) = 'true')"""


@query("spend_report", S.with_ctes(f"""
SELECT CAST(section AS INTEGER) AS section, CAST(line_no AS INTEGER) AS line_no, line FROM (
  SELECT 0 AS section, 0 AS line_no, 'Contract Analysis Report - Generated on {RUN_TS}' AS line
  UNION ALL SELECT 0, 1, '{"=" * 85}'
  UNION ALL SELECT 0, 2, ''
  UNION ALL {_report_section_sql('contracts_clean', 'All Contracts', 1)}
  UNION ALL {_report_section_sql('subset_clean', 'Munchable Contracts Only', 2)}) q""",
    "contracts_clean", extra=[_SUBSET]))
def q_spend_report(spark, sf):
    return spend.spend_report(contracts_clean(spark, sf), RUN_TS)
