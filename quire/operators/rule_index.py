"""Very many rules over texts: an index of literals that a match must contain, patterns only where one occurs.

Each pattern gives, where it can, a literal for each of its alternatives; all literals go into one Aho-Corasick automaton.
A text is read once and names its candidate rules; the JVM then tries the patterns of the candidates alone.  Rules
without a sure literal are candidates everywhere.  The plan does not depend on the number of rules.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.extract import Rule, _ordered

SHORTEST = 3  # a literal of fewer characters occurs in most texts
CANDIDATES = "_candidates"
_LOWER = {c: c + 32 for c in range(65, 91)}


def literals(pattern: str) -> list[str] | None:
    """For each top-level alternative of ``pattern`` a literal, ASCII and lower-cased, that every match holds (in any
    case); None where none is sure.  Only plain characters outside groups, classes and repetitions count."""
    if pattern.startswith("(?i)"):
        pattern = pattern[4:]
    found, run, best, depth, i = [], "", "", 0, 0
    while i <= len(pattern):
        c = pattern[i] if i < len(pattern) else "|"
        step, plain = 1, ""
        if pattern.startswith("(?", i) and not pattern.startswith(("(?:", "(?=", "(?!", "(?<"), i):
            return None  # flags inside: letters may mean more than themselves
        if c == "\\":
            if i + 1 >= len(pattern) or pattern[i + 1] in "QExu0cNpPkgRX":
                return None
            step, plain = 2, "" if pattern[i + 1].isalnum() else pattern[i + 1]
        elif c == "[":
            end = pattern.find("]", i + 2)
            if end < 0 or "[" in pattern[i + 1: end] or "\\" in pattern[i + 1: end]:
                return None
            step = end + 1 - i
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
        elif c == "{":
            step = pattern.find("}", i) + 1 - i
            if step <= 0:
                return None
        elif c not in "|^$.*+?":
            plain = c
        after = pattern[i + step: i + step + 1]
        if depth == 0 and plain and plain.isascii() and after not in ("?", "*", "{"):
            run += plain.translate(_LOWER)
            if after == "+":  # the last character may come again, so a literal ends here
                best, run = max(best, run, key=len), ""
        else:
            best, run = max(best, run, key=len), ""
        if c == "|" and depth == 0:
            if len(best) < SHORTEST:
                return None
            found.append(best)
            best = ""
        i += step
    return found


def _candidates(rules: list[Rule]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        index, always, of = ahocorasick.Automaton(), [], {}
        for i, r in enumerate(rules):
            words = literals(r.pattern)
            if words is None:
                always.append(i)
            for w in words or ():
                of.setdefault(w, []).append(i)
        for w, some in of.items():
            index.add_word(w, some)
        index.make_automaton()
        for batch in batches:
            out = []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                some = set(always) if text is not None else set()
                if text and of:
                    for _, hit in index.iter(text.translate(_LOWER)):
                        some.update(hit)
                out.append(sorted(some))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], [*batch.schema.names, CANDIDATES])

    return run


def _hits(df: DataFrame, text: str, rules: list[Rule], keep: list[str]) -> DataFrame:
    ordered = _ordered(rules)
    table = df.sparkSession.createDataFrame(
        [(i, r.rule_id, r.grp, r.verdict, r.pattern) for i, r in enumerate(ordered)],
        "_i int, rule_id string, grp string, verdict string, _pattern string")
    rows = df.select(*keep, F.col(text).alias("_text"))
    schema = T.StructType([*rows.schema.fields, T.StructField(CANDIDATES, T.ArrayType(T.IntegerType()))])
    tried = rows.mapInArrow(_candidates(ordered), schema).select(*keep, "_text", F.explode(CANDIDATES).alias("_i"))
    return tried.join(F.broadcast(table), "_i").where(F.rlike("_text", F.col("_pattern")))


def rule_match_indexed(df: DataFrame, text: str, rules: list[Rule], keep: list[str]) -> DataFrame:
    """As ``extract.rule_match`` (one row per document and matching rule), for thousands of rules.  The rules are a
    parameter: every task holds them."""
    return _hits(df, text, rules, keep).select(*keep, "rule_id", "grp", "verdict")


def classify_indexed(df: DataFrame, text: str, rules: list[Rule], key: str, default_verdict: str,
                     default_reason: str = "No rule matched") -> DataFrame:
    """As ``extract.classify_rules``, for thousands of rules; ``key`` tells the rows of ``df`` apart."""
    first = _hits(df, text, rules, [key]).groupBy(key).agg(F.min_by(F.struct("rule_id", "verdict"), "_i").alias("_first"))
    return df.join(first, key, "left").withColumns({
        "verdict": F.coalesce("_first.verdict", F.lit(default_verdict)),
        "reason": F.coalesce(F.concat(F.lit("rule "), "_first.rule_id"), F.lit(default_reason))}).drop("_first")
