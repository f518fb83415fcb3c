"""Structured extraction: request text, JSON response decoding with defaults, rule tables over text.

Decoding parses each response once with ``from_json`` against an all-string schema (typed fields would turn
``"true"`` / ``"7"`` into nulls) with a field for corrupt records, then converts per field with explicit rules.  Rule tables are small
parameter rows unrolled into one expression per rule, evaluated inside whole-stage codegen on the document's
own partition: no join, no shuffle, no broadcast of anything that grows with the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.currency import col_of
from quire.functions.text import ERROR_BUDGET, TEXT_BUDGET

# ---------------------------------------------------------------- requests


def build_request(text, head: str, tail: str, budget: int = TEXT_BUDGET) -> Column:
    """Request text = template head + text cut to the budget + template tail (templates are user input)."""
    return F.concat(F.lit(head), F.substring(col_of(text), 1, budget), F.lit(tail))


# ---------------------------------------------------------------- response decoding


@dataclass(frozen=True)
class Field:
    name: str
    kind: str            # text | bool | int | list
    default: object      # value when the key is absent or null
    on_error: object     # value in the error record of an unusable response


ERROR_REASON = "Error in analysis"
PARSE_ERROR = "Could not decode the response as a JSON object"

# Fixed field lists and defaults of the reference's four response shapes.
CONTRACT_PASS1 = [
    Field("contract_number", "text", "Not found", "Error"),
    Field("parent_contract_number", "text", "Not found", "Error"),
    Field("description", "text", "Not found", "<error>"),
    Field("vendor_name", "text", "Not found", "Error"),
    Field("total_value", "text", "Not found", "Error"),
    Field("fy25_value", "text", "Not found", "Error"),
    Field("remaining_obligations", "text", "Not found", "Error"),
    Field("contracting_officer", "text", "Not found", "Error"),
    Field("is_idiq", "bool", False, False),
    Field("is_modification", "bool", False, False),
    Field("first_pass_munchable", "text", "", "Error"),
    Field("first_pass_reason", "text", "", ERROR_REASON),
]
CONTRACT_PASS2 = [
    Field("contract_number", "text", "Not found", "Error"),
    Field("second_pass_munchable", "text", "Error", "Error"),
    Field("second_pass_reason", "text", "", ERROR_REASON),
]
MEMO_PASS1 = [
    Field("memo_id", "text", "Not found", "Error"),
    Field("title", "text", "Not found", "Error"),
    Field("description", "text", "Not found", "<error>"),
    Field("date", "text", "Not found", "Error"),
    Field("authoring_office", "text", "Not found", "Error"),
    Field("target_audience", "text", "Not found", "Error"),
    Field("contains_dei", "bool", False, False),
    Field("contains_gender_identity", "bool", False, False),
    Field("contains_covid_policy", "bool", False, False),
    Field("contains_climate", "bool", False, False),
    Field("contains_who_references", "bool", False, False),
    Field("first_pass_non_compliance_score", "int", 0, 0),
    Field("first_pass_justification", "text", "", ERROR_REASON),
]
MEMO_PASS2 = [
    Field("memo_id", "text", "Not found", "Error"),
    Field("second_pass_violations", "list", [], [ERROR_REASON]),
    Field("second_pass_score", "int", 0, 0),
    Field("suggested_remediation", "text", "", ERROR_REASON),
    Field("priority_level", "text", "low", "unknown"),
]


CORRUPT = "_corrupt"


def parse_object(c: Column, fields: list[Field]) -> Column:
    """The response as a struct of strings, in one parse; of a key that occurs twice the last value stays.  The
    field ``_corrupt`` is set where the text is not JSON; the struct is null for empty or null text."""
    schema = T.StructType([*[T.StructField(f.name, T.StringType()) for f in fields], T.StructField(CORRUPT, T.StringType())])
    return F.from_json(c, schema, {"columnNameOfCorruptRecord": CORRUPT, "allowSingleQuotes": "false"})


def is_object(text: Column, parsed: Column) -> Column:
    """Whether the whole text is one JSON object (a one-element array would also fill the struct).

    The parser stops where the first object ends, so the text is also read as the only element of an array and as the
    only value of an object: anything that follows the object breaks one of the two."""
    t = F.trim(F.translate(text, "\t\r\n", "   "))
    alone = (F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1) & (
        F.size(F.json_object_keys(F.concat(F.lit('{"v":'), text, F.lit("}")))) == 1)
    return F.coalesce(parsed.isNotNull() & parsed[CORRUPT].isNull() & t.startswith("{") & t.endswith("}") & alone, F.lit(False))


def _lit_value(v, kind: str) -> Column:
    if kind == "list":
        return F.array(*[F.lit(x) for x in v]).cast("array<string>")
    if kind == "bool":
        return F.lit(bool(v))
    if kind == "int":
        return F.lit(int(v)).cast("int")
    return F.lit(v).cast("string")


def _convert(v: Column, f: Field) -> Column:
    d = _lit_value(f.default, f.kind)
    if f.kind == "bool":
        lv = F.lower(v)
        return F.when(lv == "true", F.lit(True)).when(lv == "false", F.lit(False)).otherwise(d)
    if f.kind == "int":  # any JSON number (or number in quotes); a fraction is cut toward minus infinity
        return F.coalesce(F.floor(v.try_cast("double")).try_cast("int"), d)
    if f.kind == "list":
        return (F.when(v.isNull(), d)
                .when(F.ltrim(v).startswith("["), F.coalesce(F.from_json(v, "array<string>"), d))
                .otherwise(F.array(v)))
    return F.coalesce(v, d)


def decode_response(df: DataFrame, col: str, fields: list[Field], error_text: str = PARSE_ERROR) -> DataFrame:
    """Response text -> one typed column per field plus ``is_error``.

    Absent key or JSON null -> the field default; unusable response (not a JSON object, empty) -> the error
    record, whose description carries the first 100 characters of the error text."""
    parsed = df.withColumn("_j", parse_object(F.col(col), fields)).withColumn("_ok", is_object(F.col(col), F.col("_j")))
    cols = {}
    for f in fields:
        err = (F.lit(error_text[:ERROR_BUDGET]) if f.on_error == "<error>" else _lit_value(f.on_error, f.kind))
        cols[f.name] = F.when(F.col("_ok"), _convert(F.col(f"_j.{f.name}"), f)).otherwise(err)
    return parsed.withColumns({**cols, "is_error": ~F.col("_ok")}).drop("_ok", "_j")


# ---------------------------------------------------------------- rule tables over text


@dataclass(frozen=True)
class Rule:
    rule_id: str
    grp: str
    verdict: str
    precedence: int
    weight: int
    pattern: str


def _ordered(rules: list[Rule]) -> list[Rule]:
    return sorted(rules, key=lambda r: (r.precedence, r.rule_id))


def rule_match(df: DataFrame, text: str, rules: list[Rule], keep: list[str]) -> DataFrame:
    """One row per (document, matching rule)."""
    t = col_of(text)
    hits = [F.when(t.rlike(r.pattern), F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.grp).alias("grp"),
                                                F.lit(r.verdict).alias("verdict"))) for r in _ordered(rules)]
    return (df.select(*keep, F.explode(F.array(*hits)).alias("r")).where(F.col("r").isNotNull())
            .select(*keep, "r.rule_id", "r.grp", "r.verdict"))


def classify_rules(df: DataFrame, text: str, rules: list[Rule], default_verdict: str,
                   default_reason: str = "No rule matched") -> DataFrame:
    """Single verdict per document: the matching rule with the lowest precedence decides; reason names it.  The rules
    are one chain of cases, so patterns after the first match are not tried."""
    t, first = col_of(text), F.lit(None).cast("int")
    ordered = _ordered(rules)
    if ordered:
        first = F.when(t.rlike(ordered[0].pattern), 0)
        for i, r in enumerate(ordered[1:], 1):
            first = first.when(t.rlike(r.pattern), i)

    def pick(values: list[str], other: str) -> Column:
        return F.coalesce(F.try_element_at(F.array(*[F.lit(v) for v in values]).cast("array<string>"), F.col("_i") + 1), F.lit(other))

    return (df.withColumn("_i", first)
            .withColumns({"verdict": pick([r.verdict for r in ordered], default_verdict),
                          "reason": pick([f"rule {r.rule_id}" for r in ordered], default_reason)}).drop("_i"))


def tag_topics(df: DataFrame, text: str, rules: list[Rule], categories: list[str]) -> DataFrame:
    """One boolean ``contains_<category>`` per category (any rule of the group matches) and the matched
    categories as text, in the given category order."""
    t = col_of(text)
    flags = {}
    for cat in categories:
        pats = [r.pattern for r in rules if r.grp == cat]
        flags[f"contains_{cat}"] = (F.lit(False) if not pats else
                                    F.coalesce(t.rlike("|".join(f"(?:{p})" for p in pats)), F.lit(False)))
    out = df.withColumns(flags)
    return out.withColumn("matched_categories", F.concat_ws(
        ",", *[F.when(F.col(f"contains_{c}"), F.lit(c)) for c in categories]))


def score_and_priority(df: DataFrame, text: str, rules: list[Rule], high: int = 7, medium: int = 4) -> DataFrame:
    """Score 1..10 = weighted count of matching rules, clamped; priority from the two cut-offs (parameters)."""
    t, raw = col_of(text), F.lit(0)
    for r in rules:
        raw = raw + F.when(t.rlike(r.pattern), r.weight).otherwise(0)
    score = F.least(F.lit(10), F.greatest(F.lit(1), raw)).cast("int")
    return (df.withColumn("score", score)
            .withColumn("priority", F.when(F.col("score") >= high, F.lit("high"))
                        .when(F.col("score") >= medium, F.lit("medium")).otherwise(F.lit("low"))))


@dataclass(frozen=True)
class FieldPattern:
    field: str
    pattern: str


def extract_fields(df: DataFrame, text: str, patterns: list[FieldPattern], missing: str = "Not found") -> DataFrame:
    """First match of group 1 of each field's pattern; ``Not found`` when the pattern does not occur."""
    t = col_of(text)
    return df.withColumns({
        p.field: F.coalesce(F.nullif(F.regexp_extract(t, p.pattern, 1), F.lit("")), F.lit(missing))
        for p in patterns})
