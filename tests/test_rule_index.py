"""Thousands of rules by an index of literals, against the plain operators."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quire.operators import extract as X
from quire.operators import rule_index as I

PATTERNS = ["alpha", "(?i)BETA gamma", "colou?r", "(cat|dog)s eat", "one|two three|four", "x+yzw", "ab{2,3}cde", r"end\.$", r"\bword\b", "[abc]def ghi",
            "a.c", "(?:maybe)?surely", "no|[xyz]{3}", r"tab\there", "(?i)ümlaut case", "(?s)dot.all", "", "q(?=uick)uick", r"\Qa.b\E", "fin(ish|al)ly"]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_literals_are_in_every_match(pattern):
    words = I.literals(pattern)
    r = random.Random(pattern)
    pieces = ["alpha", "Beta Gamma", "color", "colour", "dogs eat", "one", "two three", "FOUR", "four", "xxyzw", "abbcde", "end.", "word", "bdef ghi",
              "abc", "surely", "maybesurely", "no", "xyz", "tab\there", "Ümlaut Case", "dot\nall", "quick", "a.b", "finishly", " ", "?"]
    if words is None or "\\Q" in pattern:
        return
    for _ in range(300):
        text = "".join(r.choice(pieces) for _ in range(r.randrange(1, 5)))
        if re.search(pattern, text):
            assert any(w in text.lower() for w in words), (pattern, text)


def test_sure_and_unsure_literals():
    assert I.literals("(?i)BETA gamma") == ["beta gamma"] and I.literals("one|two three") == ["one", "two three"]
    assert I.literals("colou?r") == ["colo"] and I.literals("x+yzw") == ["yzw"] and I.literals("ab{2,3}cde") == ["cde"]
    for unsure in ("a.c", "", "(cat|dog)", "(?s)dotall", "abcd|x", r"\Qabcd\E", "(?iu)kelvin"):
        assert I.literals(unsure) is None


def test_five_thousand_rules(spark):
    r = random.Random(1)
    words = [f"w{i}x{r.randrange(1000)}" for i in range(5000)]
    rules = [X.Rule(f"r{i:04d}", f"g{i % 7}", "v", r.randrange(50), 1, p) for i, p in enumerate(
        [*PATTERNS, *[r.choice([w, f"(?i){w.upper()} ", f"{w}|{w}y", f"{w}[0-9]?z"]) for w in words]])]
    texts = [" ".join(r.choice([*words[:400], "alpha", "colour", "END.", "zz", "abbcde"]) for _ in range(60)) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate([*texts, "", None, "ümlaut case xyz"])), "id int, text string")
    some = rules[:300]  # the plain operator's plan grows with the rules
    for which in (some, rules[:20]):
        plain = sorted(tuple(x) for x in X.rule_match(df, "text", which, ["id"]).collect())
        assert sorted(tuple(x) for x in I.rule_match_indexed(df, "text", which, ["id"]).collect()) == plain and plain
    want = sorted((x.id, x.verdict, x.reason) for x in X.classify_rules(df, "text", some, "n/a").collect())
    assert sorted((x.id, x.verdict, x.reason) for x in I.classify_indexed(df, "text", some, "id", "n/a").collect()) == want
    got = I.rule_match_indexed(df, "text", rules, ["id"])
    size = [len(I.rule_match_indexed(df, "text", x, ["id"])._jdf.queryExecution().optimizedPlan().toString().splitlines()) for x in (some, rules)]
    assert size[0] == size[1]
    compiled = [(x.rule_id, re.compile(x.pattern)) for x in rules if not x.pattern.startswith(r"\Q")]
    plain = sorted((i, k) for i, t in enumerate([*texts, ""]) for k, p in compiled if p.search(t))
    assert sorted((x.id, x.rule_id) for x in got.where((F.col("id") < 31) & (F.col("rule_id") != "r0018")).collect()) == plain
