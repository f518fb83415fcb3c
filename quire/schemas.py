"""Declared schemas of the result tables and the default each column takes when it is missing."""

from __future__ import annotations

from pyspark.sql import types as T

S, B, I, L = T.StringType(), T.BooleanType(), T.IntegerType(), T.LongType()

CONTRACT_RESULT = T.StructType([
    T.StructField("seq", L), T.StructField("contract_number", S), T.StructField("parent_contract_number", S),
    T.StructField("description", S), T.StructField("vendor_name", S), T.StructField("contracting_officer", S),
    T.StructField("total_value", S), T.StructField("fy25_value", S), T.StructField("remaining_obligations", S),
    T.StructField("is_idiq", B), T.StructField("is_modification", B), T.StructField("file_path", S),
    T.StructField("first_pass_munchable", S), T.StructField("first_pass_reason", S),
    T.StructField("second_pass_munchable", S), T.StructField("second_pass_reason", S),
])

# Fixed defaults of the reference's records: text fields "Not found", flags false, statuses/reasons ''.
CONTRACT_DEFAULTS = {
    "contract_number": "Not found", "parent_contract_number": "Not found", "description": "Not found",
    "vendor_name": "Not found", "contracting_officer": "Not found", "total_value": "Not found",
    "fy25_value": "Not found", "remaining_obligations": "Not found", "is_idiq": False, "is_modification": False,
    "file_path": "", "first_pass_munchable": "", "first_pass_reason": "", "second_pass_munchable": "",
    "second_pass_reason": "",
}

MEMO_FLAGS = ["contains_dei", "contains_gender_identity", "contains_covid_policy", "contains_climate",
              "contains_who_references"]

MEMO_RESULT = T.StructType([
    T.StructField("seq", L), T.StructField("memo_id", S), T.StructField("title", S), T.StructField("description", S),
    T.StructField("date", S), T.StructField("authoring_office", S), T.StructField("target_audience", S),
    *[T.StructField(f, B) for f in MEMO_FLAGS],
    T.StructField("file_path", S), T.StructField("first_pass_non_compliance_score", I),
    T.StructField("first_pass_justification", S), T.StructField("second_pass_violations", T.ArrayType(S)),
    T.StructField("second_pass_score", I), T.StructField("suggested_remediation", S),
    T.StructField("priority_level", S),
])

# Fixed defaults of back-filled memo rows: missing text is '', a missing list is empty.
MEMO_DEFAULTS = {
    "memo_id": "", "title": "", "description": "", "date": "", "authoring_office": "", "target_audience": "",
    **{f: False for f in MEMO_FLAGS}, "file_path": "", "first_pass_non_compliance_score": 0,
    "first_pass_justification": "", "second_pass_violations": [], "second_pass_score": 0,
    "suggested_remediation": "", "priority_level": "",
}
