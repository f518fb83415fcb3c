from pyspark.sql import functions as F

from quire.operators import results as R
from quire.operators.review import contract_review, contract_second_pass, memo_review, memo_second_pass


def test_contract_review_flow(spark):
    files = spark.createDataFrame([(f"/c/{i}.pdf",) for i in range(8)], "path string")
    processed = spark.createDataFrame([("/c/0.pdf", "ok"), ("/c/1.pdf", "retry")], "path string, status string")
    reviewed = spark.createDataFrame([("K3", "2024-01-01")], "contract_number string, review_date string")
    texts = spark.createDataFrame([("/c/1.pdf", "t1"), ("/c/2.pdf", ""), ("/c/3.pdf", "t3"), ("/c/4.pdf", "t4"),
                                   ("/c/5.pdf", "t5"), ("/c/6.pdf", "t6"), ("/c/7.pdf", "t7")], "path string, text string")
    a1 = spark.createDataFrame([
        ("/c/1.pdf", '{"contract_number": "K1", "description": "parent one"}'),
        ("/c/3.pdf", '{"contract_number": "K3"}'),                                     # already reviewed
        ("/c/4.pdf", '{"contract_number": "K4", "parent_contract_number": "K1", "description": "kid"}'),
        ("/c/5.pdf", "garbage"),
        ("/c/7.pdf", '{"contract_number": "K4", "description": "same number"}'),       # /c/6.pdf has no answer yet
    ], "path string, response string").withColumn("aseq", F.lit(1))
    a1 = a1.unionByName(spark.createDataFrame([("/c/4.pdf", "an earlier answer", 0)], a1.schema))
    a2 = spark.createDataFrame([("/c/1.pdf", '{"contract_number": "K1", "second_pass_munchable": "TRUE"}', 1),
                                ("/c/4.pdf", '{"contract_number": "K4", "second_pass_munchable": "false", '
                                             '"second_pass_reason": "why"}', 1)], "path string, response string, aseq int")
    out = contract_review(files, processed, reviewed, texts, a1, a2, "2025-01-01")
    st = {r.path: r.status for r in out["processed_rows"].collect()}
    assert st == {"/c/1.pdf": "ok", "/c/2.pdf": "no_text", "/c/3.pdf": "ok", "/c/4.pdf": "ok", "/c/5.pdf": "error",
                  "/c/6.pdf": "retry", "/c/7.pdf": "ok"}
    again = R.unprocessed(files, processed.where("status = 'ok'").unionByName(out["processed_rows"]))
    assert [r.path for r in again.collect()] == ["/c/6.pdf"]
    res = {r.file_path: (r.contract_number, r.second_pass_munchable, r.second_pass_reason)
           for r in out["results"].collect()}
    assert res == {"/c/1.pdf": ("K1", "true", "No reason provided"), "/c/4.pdf": ("K4", "false", "why"),
                   "/c/5.pdf": ("Error", "", ""), "/c/7.pdf": ("K4", "", "")}
    assert sorted(r.contract_number for r in out["reviewed_rows"].collect()) == ["K1", "K4"]
    req2 = {r.file_path: r.request_text for r in out["requests2"].collect()}
    assert "Child Contract Descriptions:\n- kid\n" in req2["/c/1.pdf"]
    assert "Parent Contract Description: parent one" in req2["/c/4.pdf"]
    later = contract_second_pass(out["results"], a2.replace("/c/4.pdf", "/c/5.pdf"))["results"]
    assert {r.file_path: r.second_pass_munchable for r in later.collect()}["/c/5.pdf"] == "false"


def test_memo_review_flow(spark):
    files = spark.createDataFrame([(f"/m/{i}.pdf",) for i in range(4)], "path string")
    processed = spark.createDataFrame([("/m/0.pdf", "ok")], "path string, status string")
    known = spark.createDataFrame([("M1", "2024-01-01")], "memo_id string, review_date string")
    texts = spark.createDataFrame([(f"/m/{i}.pdf", f"text {i}") for i in range(4)], "path string, text string")
    a1 = spark.createDataFrame([
        ("/m/1.pdf", '{"memo_id": "M1", "first_pass_non_compliance_score": 7, "contains_dei": true}'),
        ("/m/2.pdf", '{"memo_id": "M2", "first_pass_non_compliance_score": "2"}'),
        ("/m/3.pdf", "oops")], "path string, response string").withColumn("aseq", F.lit(1))
    a2 = spark.createDataFrame([
        ("/m/2.pdf", '{"memo_id": "M2", "second_pass_score": 9, "priority_level": "HIGH", '
                     '"second_pass_violations": ["x"]}', 1)], "path string, response string, aseq int")
    out = memo_review(files, processed, known, texts, a1, a2, "2025-01-01")
    res = {r.memo_id: (r.flagged, r.priority_level, r.second_pass_score) for r in out["results"].collect()}
    assert res == {"M2": (True, "HIGH", 9), "Error": (False, "", 0)}                   # M1 is known already
    assert [r.memo_id for r in out["ledger_rows"].collect()] == ["M2"]
    assert [r.memo_id for r in out["manifest"].collect()] == ["M2"]
    assert {r.flag: r.n for r in out["flag_counts"].collect()}["contains_dei"] == 0
    assert {r.path: r.status for r in out["processed_rows"].collect()} == {"/m/1.pdf": "ok", "/m/2.pdf": "ok", "/m/3.pdf": "error"}
    assert {r.status: r.n for r in out["priorities"].collect()} == {"HIGH": 1, "": 1}
    later = memo_second_pass(out["results"].drop("second_pass_violations"), a2.where("false"))["results"].collect()
    assert {r.memo_id: (r.second_pass_violations, r.second_pass_score) for r in later} == {"M2": ([], 9), "Error": ([], 0)}
