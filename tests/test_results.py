from pyspark.sql import functions as F

from quire.operators import results as R

REC = "seq long, contract_number string, parent_contract_number string, description string, " \
      "first_pass_munchable string, first_pass_reason string, second_pass_munchable string, second_pass_reason string"


def _records(spark):
    return spark.createDataFrame([
        (1, "P", "Not found", "parent", "true", "", "false", ""),
        (2, "C1", "P", "child one", "true", "nan", "true", ""),
        (3, "C2", "P", "child two", "", None, "n/a", ""),
        (4, "Not found", "Not found", "lost", "", "", "", ""),
        (5, "C1", "P", "child one again", "", "", "", ""),
    ], REC)


def test_upsert_last_wins_keeps_rows_and_skips_sentinels(spark):
    res = _records(spark)
    upd = spark.createDataFrame([
        ("C1", "false", "finance", "false", "x", 1), ("C1", "true", "nan", "true", None, 2),
        ("Not found", "true", "", "true", "", 3)],
        "contract_number string, first_pass_munchable string, first_pass_reason string, "
        "second_pass_munchable string, second_pass_reason string, useq long")
    out = R.upsert_results(res, upd)
    assert out.count() == res.count()
    rows = {r.seq: r for r in out.collect()}
    assert rows[2].second_pass_munchable == "true" and rows[5].second_pass_munchable == "true"
    assert rows[2].first_pass_reason == "" and rows[2].second_pass_reason == ""   # whole-value nan / null -> ''
    assert rows[4].second_pass_munchable == ""                                     # sentinel never matches


def test_context_text(spark):
    out = {r.seq: r.context_text for r in R.context_text(_records(spark)).collect()}
    assert out[1] == ("Current Contract Description: parent\n\nChild Contract Descriptions:\n"
                      "- child one\n- child two\n- child one again\n")
    assert out[2] == "Current Contract Description: child one\n\nParent Contract Description: parent\n\n"
    assert out[4] == "Current Contract Description: lost\n\n"                     # sentinel parent: no join


def test_ledger_rerun_is_noop(spark):
    rec = _records(spark)
    ledger = spark.createDataFrame([("P", "2024-01-01")], "contract_number string, review_date string")
    once = R.append_ledger(rec, ledger, "2025-01-01")
    twice = R.append_ledger(rec, once, "2025-01-02")
    assert sorted(r[0] for r in once.select("contract_number").collect()) == ["C1", "C2", "P"]
    assert twice.count() == once.count()
    assert R.skip_reviewed(rec, once).select("contract_number").collect()[0][0] == "Not found"


def test_chunk_rows_and_ordering(spark):
    df = spark.range(0, 103).select((F.col("id") * 3).alias("seq")).repartition(5)
    got = {r.seq: r.chunk_no for r in R.chunk_rows(df, 25).collect()}
    assert all(got[s] == (s // 3) // 25 for s in got)
    order = [r.second_pass_munchable for r in R.order_by_status(_records(spark)).collect()]
    assert order == ["true", "false", "n/a", "", ""]


def test_children_of_a_hot_parent_are_all_kept(spark):
    rows = [(i, f"C{i}", "hot", f"child {i}") for i in range(5000)] + [(9000 + i, f"D{i}", f"C{i}", "x") for i in range(50)]
    df = spark.createDataFrame(rows, "seq long, contract_number string, parent_contract_number string, description string").repartition(7)
    full = "Child Contract Descriptions:\n" + "".join(f"- child {i}\n" for i in range(5000))
    for budget in (40, 10_000, 10**6):
        got = {r._ckey: r.child_block for r in R.context_children(df, budget=budget).collect()}
        assert got["hot"] == full[:budget] and len(got) == 51


def test_sentinels_take_no_answer(spark):
    res = spark.createDataFrame([(1, "Not found", "", ""), (2, "K", "", "")],
                                "seq int, contract_number string, second_pass_munchable string, second_pass_reason string")
    ans = spark.createDataFrame([("Not found", "Not found", "TRUE", "x", 1), ("K", "K", "TRUE", "y", 1)],
                                "request_id string, contract_number string, second_pass_munchable string, second_pass_reason string, aseq int")
    assert {r.seq: r.second_pass_munchable for r in R.attach_second_pass(res, ans).collect()} == {1: "", 2: "true"}


def test_backfill_keeps_nulls_of_present_columns(spark):
    from quire import schemas
    df = spark.createDataFrame([("K", None, None)], "contract_number string, vendor_name string, first_pass_reason string")
    row = R.backfill_columns(df, schemas.CONTRACT_RESULT, schemas.CONTRACT_DEFAULTS, fill=("first_pass_reason",)).first()
    assert row.vendor_name is None and row.first_pass_reason == "" and row.description == "Not found" and row.is_idiq is False


def test_list_text_round_trip(spark):
    from quire.functions.text import list_to_text, text_to_list
    lists = [["a; b", "c"], [], ['q"uote', "new\nline"], None]
    df = spark.createDataFrame([(x,) for x in lists], "v array<string>")
    assert [r[0] for r in df.select(text_to_list(list_to_text("v"))).collect()] == lists
