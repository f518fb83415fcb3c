
from quire.operators import spend

SCHEMA = "seq long, contract_number string, parent_contract_number string, vendor_name string, " \
         "total_value string, fy25_value string, second_pass_munchable string"


def _df(spark):
    return spark.createDataFrame([
        (1, "A", "Not found", "V1", "$100", "$10", "true"),
        (2, "B1", "P", "V2", "2 million", "$1", "false"),
        (3, "B2", "P", "V2", "$999", "$2", "true"),          # second child of P: not counted in totals
        (4, "C", "", "V1", "1,000", "Not found", "TRUE"),      # empty parent -> standalone
        (5, "D", "Q", None, "$5", "$5", "n/a"),                # null vendor: dropped from vendor roll-up
    ], SCHEMA)


def test_spend_totals_first_child_per_parent(spark):
    t = spend.spend_totals(spend.with_clean_money(_df(spark))).first()
    assert float(t.total_value) == 100 + 2_000_000 + 1000 + 5
    assert float(t.fy25_value) == 10 + 1 + 0 + 5
    assert t.n_contracts == 4
    assert spend.unique_contract_count(_df(spark)).first().n_contracts == 4


def test_vendor_totals_and_rank(spark):
    top = spend.top_vendors(spend.with_clean_money(_df(spark)), 100).orderBy("vendor_rank").collect()
    assert [(r.vendor_name, float(r.total_value), r.vendor_rank) for r in top] == [
        ("V2", 2_000_999.0, 1), ("V1", 1100.0, 2)]


def test_report_layout(spark):
    rep = spend.spend_report(spend.with_clean_money(_df(spark)), "2025-01-01 00:00:00")
    lines = [r.line for r in rep.orderBy("section", "line_no").collect()]
    assert lines[0] == "Contract Analysis Report - Generated on 2025-01-01 00:00:00"
    assert lines[1] == "=" * 85 and lines[2] == "" and lines[3] == "" and lines[4] == "All Contracts"
    assert "Total Contract Value: $2.00M" in lines
    assert "Munchable Contracts Only" in lines
    subset_count = lines[lines.index("Munchable Contracts Only"):]
    assert "Number of Unique Contracts: 3" in subset_count     # A, B2 (parent P), C
