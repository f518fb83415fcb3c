import json

import pytest

from quire.operators import extract as X


def test_decode_cases(spark):
    cases = [
        (1, '{"memo_id": "M1", "second_pass_violations": ["a", "b"], "second_pass_score": 7, '
            '"suggested_remediation": "fix", "priority_level": "High"}'),
        (2, '{"memo_id": "M2"}'),                                             # missing keys
        (3, '{"memo_id": null, "second_pass_score": null}'),                  # explicit nulls
        (4, '{"memo_id": "M4", "second_pass_score": "9", "second_pass_violations": "one text"}'),
        (5, '{"memo_id": "M5", "extra": {"x": 1}, "second_pass_score": 7.5}'),
        (6, "not json"), (7, ""), (8, "[1, 2]"), (9, '[{"memo_id": "M9"}]'), (10, None), (11, '{"memo_id": "cut'),
        (12, '{"memo_id": "old", "second_pass_score": 8.0, "memo_id": "new"}'),
    ]
    df = spark.createDataFrame(cases, "seq int, response string")
    out = {r.seq: r for r in X.decode_response(df, "response", X.MEMO_PASS2).collect()}
    assert out[1].second_pass_violations == ["a", "b"] and out[1].second_pass_score == 7
    assert out[2].priority_level == "low" and out[2].second_pass_violations == []
    assert out[3].memo_id == "Not found" and out[3].second_pass_score == 0
    assert out[4].second_pass_score == 9 and out[4].second_pass_violations == ["one text"]
    assert out[5].second_pass_score == 7 and not out[5].is_error
    assert out[12].memo_id == "new" and out[12].second_pass_score == 8
    for k in (6, 7, 8, 9, 10, 11):
        assert out[k].is_error and out[k].priority_level == "unknown" and out[k].memo_id == "Error"


def test_rules_precedence_and_topics(spark):
    rules = [X.Rule("a", "g1", "false", 1, 5, "alpha"), X.Rule("b", "g2", "true", 2, 3, "beta")]
    df = spark.createDataFrame([(1, "beta alpha"), (2, "beta"), (3, "none")], "id int, text string")
    got = {r.id: (r.verdict, r.reason) for r in X.classify_rules(df, "text", rules, "n/a").collect()}
    assert got == {1: ("false", "rule a"), 2: ("true", "rule b"), 3: ("n/a", "No rule matched")}
    tags = {r.id: r.matched_categories for r in X.tag_topics(df, "text", rules, ["g1", "g2"]).collect()}
    assert tags == {1: "g1,g2", 2: "g2", 3: ""}
    sc = {r.id: (r.score, r.priority) for r in X.score_and_priority(df, "text", rules).collect()}
    assert sc == {1: (8, "high"), 2: (3, "low"), 3: (1, "low")}


ODD = ['{"memo_id": "M1"}', ' \n{"memo_id":"M1"}\t', "{'memo_id': 'M1'}", '{"memo_id": \'M1\'}', '{memo_id: "M1"}', '{"memo_id":"M1"}{"memo_id":"M2"}',
       '{"memo_id":"M1"} x}', '{"memo_id":"M1"} {}', '{"memo_id":"M1"},{"memo_id":"M2"}', '{"memo_id":"M1"}],[{"memo_id":"M2"}',
       '{"memo_id":"M1"}, "w":{"memo_id":"M2"}', '{"memo_id":"M1"}} {"memo_id":"M2"}', '{"memo_id":"M1",}', '{"memo_id":"M1"}]',
       '[{"memo_id":"M1"}]', '{"memo_id":"a\nb"}', '{"memo_id":"a\\nb"}', '{}', '{"memo_id":"}{"}', '{"memo_id":"M1"} // x }', "x", '"x"', "1",
       '{"memo_id":"M1","x":[1,{"y":"]"}]}', '{"memo_id":"M1","x":01}', '{"memo_id":"M1","x":[1,]}', '{"memo_id":"M1"', '{"memo_id":"\\q"}']


@pytest.mark.parametrize("col", ["memo_id"])
def test_accepts_what_the_json_module_accepts(spark, col):
    def ok(text):
        try:
            return isinstance(json.loads(text), dict)
        except ValueError:
            return False

    df = spark.createDataFrame(list(enumerate(ODD)), "seq int, response string")
    got = {r.seq: (r.is_error, r[col]) for r in X.decode_response(df, "response", X.MEMO_PASS1).collect()}
    for i, text in enumerate(ODD):
        want = (not ok(text), json.loads(text).get(col, "Not found") if ok(text) else "Error")
        assert got[i] == want, text
