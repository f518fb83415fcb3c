import pytest
from pyspark.sql import functions as F

from quire.functions.currency import clean_currency, format_currency, money, report_line

# Golden table: input text -> cleaned value (derived by reading the reference's cleaning rules).
GOLDEN = [
    (None, 0.0), ("Not found", 0.0),
    ("$1,234,567.89", 1234567.89), ("USD 12.50", 12.5), ("1,234", 1234.0),
    ("2.5 million", 2_500_000.0), ("$1,500 million", 1_500_000_000.0), ("5 million dollars", 5_000_000.0),
    ("-2 million", -2_000_000.0), ("about 5 million", 0.0),
    ("3.1M", 3_100_000.0), ("$ 4 m", 4_000_000.0), ("5mm", 5_000_000.0), ("1.2.3m", 0.0),
    ("1.2.3", 1.23), ("-5", 5.0), ("(5)", 5.0), ("1.5 billion", 1.5), ("7k", 7.0),
    ("Error", 0.0), ("n/a", 0.0), ("", 0.0), (".", 0.0), ("  $ 10.5  ", 10.5), ("1e3 million", 1e9),
]


def test_clean_currency_golden(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(GOLDEN)], "i int, v string")
    got = {r.i: r.c for r in df.select("i", clean_currency("v").alias("c")).collect()}
    for i, (v, want) in enumerate(GOLDEN):
        assert got[i] == pytest.approx(want), v


def test_clean_currency_idempotent_on_clean_values(spark):
    vals = [0.5, 12.0, 1234.56, 99999.99]
    df = spark.createDataFrame([(str(v),) for v in vals], "v string")
    got = [r[0] for r in df.select(clean_currency("v")).collect()]
    assert got == pytest.approx(vals)


FORMAT = [
    (0, "$0.00"), (12.34, "$12.34"), (999.99, "$999.99"), (1000, "$1.00K"), (1234.5, "$1.23K"),
    (1_000_000, "$1.00M"), (2_345_678.9, "$2.35M"), (1_000_000_000, "$1.00B"), (-5, "$-5.00"),
    (999_999.99, "$1000.00K"), (92_233_720_368_547_758.07, "$92233720.37B"), (10**22, "$10000000000000.00B"),
]


def test_amounts_that_do_not_fit(spark):
    texts = ["$" + "1234567890123456789012" * 2, "9e999 million", "1e300 million", "$5"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(money(clean_currency("v"))).collect()]
    assert [float(g) for g in got] == [0.0, 0.0, 0.0, 5.0]
    assert df.select(F.sum(money(clean_currency("v")))).first()[0] == 5


def test_unit_is_chosen_before_rounding(spark):
    df = spark.createDataFrame([(999_999.999,), (999_999_999.999,), (float("inf"),)], "v double")
    assert [r[0] for r in df.select(format_currency("v")).collect()] == ["$1000.00K", "$1000.00M", None]


def test_format_currency(spark):
    df = spark.createDataFrame([(str(v), w) for v, w in FORMAT], "v string, w string")
    for r in df.select(format_currency(F.col("v").cast("decimal(28,2)")).alias("f"), "w").collect():
        assert r.f == r.w


def test_report_line_widths(spark):
    df = spark.createDataFrame([(1, "A" * 60, "$1.00M", "$2.00K")], "r int, v string, t string, f string")
    line = df.select(report_line("r", "v", "t", "f")).first()[0]
    assert line == f"{'1':<4} {'A' * 50:<50} {'$1.00M':>15} {'$2.00K':>15}"


def test_unicode_whitespace_like_python_strip(spark):
    df = spark.createDataFrame([("5\xa0million",), (" $7　",)], "v string")
    got = [r[0] for r in df.select(clean_currency("v")).collect()]
    assert got == [5_000_000.0, 7.0]
