"""Document queries: page assembly, text cache, JSON response decoding, rule tables, flags, priorities.

The model responses are built from the driver tables by plain SQL that Spark SQL and DuckDB both accept, so
Spark and the oracle decode the very same text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quire import schemas
from quire.functions.text import error_text, is_sentinel, list_to_text, truncate_text
from quire.operators import documents as D
from quire.operators import extract as X
from quire.operators import results as R
from quire.operators.rule_index import classify_indexed, rule_match_indexed
from quire.plans import sql_parts as S
from quire.plans.org_queries import scratch
from quire.plans.registry import query
from quire.schemas import MEMO_FLAGS
from quire.sources import files, tables

# ---------------------------------------------------------------- responses (shared SQL)

CONTRACT_P1_RESPONSE = """CASE seq % 10
  WHEN 7 THEN 'The model could not answer.'
  WHEN 8 THEN ''
  WHEN 5 THEN '{"contract_number": "' || contract_number || '", "description": "' || description || '"}'
  WHEN 6 THEN '{"contract_number": "' || contract_number || '", "vendor_name": null, "is_idiq": null, "total_value": null}'
  WHEN 9 THEN '{"contract_number": "' || contract_number || '", "is_idiq": "TRUE", "is_modification": "no", '
              || '"extra": {"a": [1, 2]}, "total_value": 12345, "first_pass_munchable": true}'
  ELSE '{"contract_number": "' || contract_number || '", "parent_contract_number": "' || parent_contract_number
       || '", "description": "' || description || '", "vendor_name": ' || coalesce('"' || vendor_name || '"', 'null')
       || ', "total_value": ' || coalesce('"' || total_value || '"', 'null') || ', "fy25_value": "' || fy25_value
       || '", "remaining_obligations": "' || remaining_obligations || '", "contracting_officer": "'
       || contracting_officer || '", "is_idiq": ' || CAST(is_idiq AS STRING) || ', "is_modification": '
       || CAST(is_modification AS STRING) || ', "first_pass_munchable": "' || first_pass_munchable
       || '", "first_pass_reason": ' || coalesce('"' || first_pass_reason || '"', 'null') || '}'
END"""

CONTRACT_P2_RESPONSE = """CASE seq % 6
  WHEN 4 THEN 'rate limited'
  WHEN 5 THEN '{"contract_number": "' || contract_number || '"}'
  ELSE '{"contract_number": "' || contract_number || '", "second_pass_munchable": "'
       || CASE seq % 3 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'false' ELSE 'N/A' END || '", "second_pass_reason": '
       || CASE WHEN seq % 4 = 0 THEN 'null' ELSE '"reason ' || CAST(seq % 4 AS STRING) || '"' END || '}'
END"""

MEMO_P1_RESPONSE = """CASE d.doc_id % 9
  WHEN 7 THEN 'not json at all'
  WHEN 8 THEN '{"memo_id": "M' || CAST(d.doc_id AS STRING) || '", "title": "cut'
  ELSE '{"memo_id": "M' || CAST(d.doc_id AS STRING) || '", "title": "' || d.lang || ' memo "'
       || ', "description": "from ' || d.source || '", "date": "2025-01-'
       || lpad(CAST(d.doc_id % 28 + 1 AS STRING), 2, '0') || '", "authoring_office": "' || d.source
       || '", "target_audience": ' || CASE WHEN d.doc_id % 5 = 0 THEN 'null' ELSE '"All staff"' END
       || ', "contains_dei": ' || CASE WHEN l.quality = 1 THEN 'true' ELSE 'false' END
       || ', "contains_climate": ' || CASE WHEN l.toxic = 1 THEN '"true"' ELSE 'false' END
       || ', "contains_covid_policy": ' || CASE WHEN d.n_chars > 5000 THEN 'true' ELSE 'false' END
       || ', "first_pass_non_compliance_score": '
       || CASE WHEN d.doc_id % 4 = 0 THEN '"' || CAST(d.doc_id % 11 AS STRING) || '"' ELSE CAST(d.doc_id % 11 AS STRING) END
       || ', "first_pass_justification": "length ' || CAST(d.n_chars AS STRING) || '"}'
END"""


def memo_p2_response(alias: str = "") -> str:
    """Pass-2 memo answer built from a documents row (``alias`` prefixes the columns, e.g. ``"d."``)."""
    d = alias
    return f"""CASE {d}doc_id % 8
  WHEN 6 THEN ''
  WHEN 7 THEN '{{"memo_id": "M' || CAST({d}doc_id AS STRING) || '", "second_pass_violations": "Pronoun guidance", '
              || '"priority_level": "HIGH"}}'
  ELSE '{{"memo_id": "' || CASE WHEN {d}doc_id % 16 = 1 THEN 'Not found' ELSE 'M' || CAST({d}doc_id AS STRING) END
       || '", "second_pass_violations": '
       || CASE WHEN {d}doc_id % 3 = 0 THEN '[]' ELSE '["violation ' || CAST({d}doc_id % 5 AS STRING) || '", "term ' || {d}lang || '"]' END
       || ', "second_pass_score": ' || CAST({d}doc_id % 10 + 1 AS STRING) || ', "suggested_remediation": "revise section '
       || CAST({d}doc_id % 7 AS STRING) || '", "priority_level": "'
       || CASE {d}doc_id % 4 WHEN 0 THEN 'High' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' ELSE '' END || '"}}'
END"""


MEMO_P2_RESPONSE = memo_p2_response()

RESP_CTES = [
    f"c_p1 AS (SELECT seq, {CONTRACT_P1_RESPONSE} AS response FROM contracts)",
    f"c_p2 AS (SELECT seq, {CONTRACT_P2_RESPONSE} AS response FROM contracts)",
    f"m_p1 AS (SELECT d.doc_id AS seq, {MEMO_P1_RESPONSE} AS response FROM documents d "
    f"LEFT JOIN labels l ON d.doc_id = l.doc_id)",
    f"m_p2 AS (SELECT doc_id AS seq, {MEMO_P2_RESPONSE} AS response FROM documents)",
]


def contract_p1(spark, sf):
    return tables.contracts(spark, sf).selectExpr("seq", f"{CONTRACT_P1_RESPONSE} as response")


def contract_p2(spark, sf):
    return tables.contracts(spark, sf).selectExpr("seq", f"{CONTRACT_P2_RESPONSE} as response")


def memo_p1(spark, sf):
    d = tables.load(spark, sf, "documents").alias("d")
    lab = tables.load(spark, sf, "labels", spread_rows=False).alias("l")
    return d.join(lab, F.col("d.doc_id") == F.col("l.doc_id"), "left").selectExpr(
        "d.doc_id as seq", f"{MEMO_P1_RESPONSE} as response")


def memo_p2(spark, sf):
    return tables.load(spark, sf, "documents").selectExpr("doc_id as seq", f"{MEMO_P2_RESPONSE} as response")


# ---------------------------------------------------------------- decoding: SQL side


def _decode_sql(src: str, fields: list[X.Field], error_text_: str = X.PARSE_ERROR) -> str:
    ok = "(coalesce(json_valid(response), false) AND ltrim(response) LIKE '{%')"
    cols = ["seq"]
    for f in fields:
        v = f"json_extract_string(response, '$.{f.name}')"
        if f.kind == "bool":
            conv = f"CASE WHEN lower({v}) = 'true' THEN true WHEN lower({v}) = 'false' THEN false ELSE {str(f.default).lower()} END"
            err = str(f.on_error).lower()
        elif f.kind == "int":
            conv = f"coalesce(TRY_CAST(floor(TRY_CAST({v} AS DOUBLE)) AS INTEGER), {f.default})"
            err = str(f.on_error)
        elif f.kind == "list":
            d = "[" + ", ".join(f"'{x}'" for x in f.default) + "]::VARCHAR[]"
            conv = (f"CASE WHEN {v} IS NULL THEN {d} WHEN ltrim({v}) LIKE '[%' "
                    f"THEN coalesce(from_json({v}, '[\"VARCHAR\"]'), {d}) ELSE [{v}] END")
            err = "[" + ", ".join(f"'{x}'" for x in f.on_error) + "]::VARCHAR[]"
        else:
            conv = f"coalesce({v}, '{f.default}')"
            err = f"'{error_text_[:100]}'" if f.on_error == "<error>" else f"'{f.on_error}'"
        cols.append(f"CASE WHEN {ok} THEN {conv} ELSE {err} END AS {f.name}")
    cols.append(f"NOT {ok} AS is_error")
    return f"SELECT {', '.join(cols)} FROM {src}"


def _listify(sql: str, cols: list[str]) -> str:
    """Arrays leave as JSON text so both engines compare plain strings."""
    return f"SELECT * REPLACE ({', '.join(f'CAST(to_json({c}) AS VARCHAR) AS {c}' for c in cols)}) FROM ({sql}) t"


def _q(body: str, *names: str) -> str:
    return S.with_ctes(body, "contracts", *names, extra=RESP_CTES)


@query("decode_contract_pass1", _q(_decode_sql("c_p1", X.CONTRACT_PASS1)))
def q_decode_contract_pass1(spark, sf):
    return X.decode_response(contract_p1(spark, sf), "response", X.CONTRACT_PASS1).drop("response")


@query("decode_contract_pass2", _q(_decode_sql("c_p2", X.CONTRACT_PASS2)))
def q_decode_contract_pass2(spark, sf):
    return X.decode_response(contract_p2(spark, sf), "response", X.CONTRACT_PASS2).drop("response")


@query("decode_memo_pass1", _q(_decode_sql("m_p1", X.MEMO_PASS1)))
def q_decode_memo_pass1(spark, sf):
    return X.decode_response(memo_p1(spark, sf), "response", X.MEMO_PASS1).drop("response")


def _memo2(spark, sf):
    return X.decode_response(memo_p2(spark, sf), "response", X.MEMO_PASS2).drop("response")


@query("decode_memo_pass2", _q(_listify(_decode_sql("m_p2", X.MEMO_PASS2), ["second_pass_violations"])))
def q_decode_memo_pass2(spark, sf):
    return _memo2(spark, sf).withColumn("second_pass_violations", list_to_text("second_pass_violations"))


@query("list_to_text", _q(f"""
SELECT seq, CAST(to_json(second_pass_violations) AS VARCHAR) AS violations_text
FROM ({_decode_sql("m_p2", X.MEMO_PASS2)}) t"""))
def q_list_to_text(spark, sf):
    return _memo2(spark, sf).select("seq", list_to_text("second_pass_violations").alias("violations_text"))


@query("memo_results_csv", _q(f"""
SELECT seq, nullif(memo_id, '') AS memo_id, CAST(NULL AS VARCHAR) AS title, CAST(to_json(second_pass_violations) AS VARCHAR) AS violations_text,
       second_pass_score, nullif(suggested_remediation, '') AS suggested_remediation, nullif(priority_level, '') AS priority_level
FROM ({_decode_sql("m_p2", X.MEMO_PASS2)}) t"""), note="memo results written as CSV with their list column, and read back")
def q_memo_results_csv(spark, sf):
    path = scratch(spark, "memo-csv")
    files.write_results_csv(R.backfill_columns(_memo2(spark, sf), schemas.MEMO_RESULT, schemas.MEMO_DEFAULTS), path)
    back = files.scan_results_csv(spark, path, schemas.MEMO_RESULT)
    return back.select("seq", "memo_id", "title", list_to_text("second_pass_violations").alias("violations_text"), "second_pass_score",
                       "suggested_remediation", "priority_level")


@query("error_record", _q(f"""
SELECT seq, contract_number, description, first_pass_munchable, first_pass_reason
FROM ({_decode_sql("c_p1", X.CONTRACT_PASS1)}) t WHERE is_error"""))
def q_error_record(spark, sf):
    d = X.decode_response(contract_p1(spark, sf), "response", X.CONTRACT_PASS1)
    return d.where("is_error").select("seq", "contract_number", "description", "first_pass_munchable",
                                      "first_pass_reason")


@query("flag_by_score", _q(f"""
SELECT seq, memo_id FROM ({_decode_sql("m_p1", X.MEMO_PASS1)}) t
WHERE first_pass_non_compliance_score >= 5 AND memo_id NOT IN ('Not found', 'Error')"""))
def q_flag_by_score(spark, sf):
    d = X.decode_response(memo_p1(spark, sf), "response", X.MEMO_PASS1)
    return d.where((F.col("first_pass_non_compliance_score") >= 5) & ~is_sentinel("memo_id")).select("seq", "memo_id")


@query("flag_by_priority", _q(f"""
SELECT seq, memo_id FROM ({_decode_sql("m_p2", X.MEMO_PASS2)}) t
WHERE lower(priority_level) = 'high' AND memo_id NOT IN ('Not found', 'Error')"""))
def q_flag_by_priority(spark, sf):
    d = _memo2(spark, sf)
    return d.where((F.lower("priority_level") == "high") & ~is_sentinel("memo_id")).select("seq", "memo_id")


_ODD = """CASE doc_id % 14
  WHEN 0 THEN '{"memo_id": "old", "first_pass_non_compliance_score": 1, "memo_id": "M' || CAST(doc_id AS STRING) || '", "first_pass_non_compliance_score": 8.0}'
  WHEN 1 THEN '{"memo_id": "M1", "first_pass_non_compliance_score": 7.5}'
  WHEN 2 THEN '{"memo_id": "M2", "first_pass_non_compliance_score": "7.5", "contains_dei": "TRUE"}'
  WHEN 3 THEN '{"memo_id": "M3", "first_pass_non_compliance_score": 12345678901}'
  WHEN 4 THEN '{"memo_id": "M4", "first_pass_non_compliance_score": 9'
  WHEN 5 THEN '[{"memo_id": "M5"}]'
  WHEN 6 THEN '{"memo_id": null, "first_pass_non_compliance_score": null, "contains_dei": 1}'
  WHEN 7 THEN CAST(NULL AS STRING)
  WHEN 9 THEN "{'memo_id': 'M9'}"
  WHEN 10 THEN '{"memo_id": "M10"}{"memo_id": "M10"}'
  WHEN 11 THEN '{"memo_id": "M11"} x}'
  WHEN 12 THEN '{"memo_id": "M12"}, "w": {"memo_id": "M12"}'
  WHEN 13 THEN ' {"memo_id": "M13"}],[{"memo_id": "M13"} '
  ELSE '{"memo_id": 17, "first_pass_non_compliance_score": -2.5, "contains_dei": true}' END"""


@query("decode_memo_odd", """
SELECT doc_id AS seq, CASE doc_id % 14 WHEN 0 THEN 'M' || doc_id WHEN 1 THEN 'M1' WHEN 2 THEN 'M2' WHEN 3 THEN 'M3' WHEN 6 THEN 'Not found'
                            WHEN 8 THEN '17' ELSE 'Error' END AS memo_id,
       CAST(CASE doc_id % 14 WHEN 0 THEN 8 WHEN 1 THEN 7 WHEN 2 THEN 7 WHEN 8 THEN -3 ELSE 0 END AS INTEGER) AS first_pass_non_compliance_score,
       doc_id % 14 IN (2, 8) AS contains_dei, doc_id % 14 IN (4, 5, 7, 9, 10, 11, 12, 13) AS is_error
FROM documents""", note="answers with repeated keys, fractions, large numbers, cut text, arrays, nulls, single quotes and text after the object; expected values by hand")
def q_decode_memo_odd(spark, sf):
    rows = tables.load(spark, sf, "documents").selectExpr("doc_id as seq", f"{_ODD} as response")
    return X.decode_response(rows, "response", X.MEMO_PASS1).select(
        "seq", "memo_id", "first_pass_non_compliance_score", "contains_dei", "is_error")


@query("flag_counts", _q(" UNION ALL ".join(
    f"SELECT '{f}' AS flag, count(*) FILTER (WHERE {f}) AS n FROM ({_decode_sql('m_p1', X.MEMO_PASS1)}) t"
    for f in MEMO_FLAGS)))
def q_flag_counts(spark, sf):
    d = X.decode_response(memo_p1(spark, sf), "response", X.MEMO_PASS1)
    return R.flag_counts(d, MEMO_FLAGS)


@query("order_by_priority", _q(f"""
SELECT seq, memo_id, priority_level, second_pass_score,
       CAST(CASE lower(priority_level) WHEN 'high' THEN 0 WHEN 'medium' THEN 1 WHEN 'low' THEN 2 WHEN '' THEN 3 END
            AS INTEGER) AS priority_rank
FROM ({_decode_sql("m_p2", X.MEMO_PASS2)}) t
ORDER BY priority_rank NULLS LAST, second_pass_score DESC NULLS LAST, seq"""))
def q_order_by_priority(spark, sf):
    return R.order_by_priority(_memo2(spark, sf)).select("seq", "memo_id", "priority_level", "second_pass_score",
                                                        "priority_rank")


_WORD_RULES = """
SELECT word, '(?i) ' || word || '[ ,.]' AS pattern FROM (
  SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS word FROM benchmark) w WHERE regexp_full_match(word, '[a-z]{5,}')"""


def _word_rules(spark, sf) -> list[X.Rule]:
    """A rule for each longer word of the benchmark items (rules are a parameter of the operator)."""
    words = tables.load(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("word")).distinct()
    return [X.Rule(r.word, "word", "seen", 1, 1, f"(?i) {r.word}[ ,.]")
            for r in words.where(F.col("word").rlike("^[a-z]{5,}$")).toLocalIterator()]


@query("rule_match_many", f"""
SELECT doc_id, word AS rule_id FROM documents, ({_WORD_RULES}) r WHERE contains(lower(text), ' ' || word) AND regexp_matches(text, pattern)""",
       note="hundreds of rules: an index of their literals names the candidates of each text")
def q_rule_match_many(spark, sf):
    docs = tables.load(spark, sf, "documents").select("doc_id", "text")
    return rule_match_indexed(docs, "text", _word_rules(spark, sf), ["doc_id"]).select("doc_id", "rule_id")


@query("classify_many", f"""
SELECT doc_id, CASE WHEN min(word) IS NULL THEN 'n/a' ELSE 'seen' END AS verdict,
       coalesce('rule ' || min(word), 'No rule matched') AS reason
FROM documents LEFT JOIN ({_WORD_RULES}) r ON contains(lower(text), ' ' || word) AND regexp_matches(text, pattern) GROUP BY doc_id""")
def q_classify_many(spark, sf):
    docs = tables.load(spark, sf, "documents").select("doc_id", "text")
    return classify_indexed(docs, "text", _word_rules(spark, sf), "doc_id", "n/a").select("doc_id", "verdict", "reason")


# ---------------------------------------------------------------- pages, cache, text budget


@query("concat_pages", S.with_ctes("""
SELECT doc_id, coalesce(string_agg(CASE WHEN ok THEN page_text END, '' ORDER BY page_no), '') AS text
FROM page_texts GROUP BY doc_id""",
    "page_texts"))
def q_concat_pages(spark, sf):
    return D.concat_pages(tables.page_texts(spark, sf))


@query("concat_pages_payload", S.with_ctes(f"""
SELECT doc_id, nullif({S.strip_ws(f"string_agg(CASE WHEN {S.strip_ws('page_text')} <> '' THEN page_text || chr(10) END, '' ORDER BY page_no)")}, '') AS text
FROM page_texts GROUP BY doc_id""", "page_texts"))
def q_concat_pages_payload(spark, sf):
    return D.concat_pages(tables.page_texts(spark, sf), ok=None, sep="\n", strip=True)


@query("drop_empty_text", S.with_ctes("""
SELECT doc_id, CASE WHEN coalesce(length(text), 0) > 0 THEN 'ok' ELSE 'no_text' END AS status
FROM (SELECT p.doc_id, string_agg(CASE WHEN ok THEN page_text END, '' ORDER BY page_no) AS text
      FROM page_texts p GROUP BY p.doc_id) t""", "page_texts"))
def q_drop_empty_text(spark, sf):
    return D.drop_empty_text(D.concat_pages(tables.page_texts(spark, sf))).select("doc_id", "status")


@query("text_cache_lookup", S.with_ctes("""
SELECT seq, path_md5, text, from_cache FROM (
  SELECT m.seq, md5(m.file_path) AS path_md5, m.text, true AS from_cache FROM memos m WHERE m.seq % 3 = 0
  UNION ALL
  SELECT m.seq, md5(m.file_path), m.text, false FROM memos m WHERE m.seq % 3 <> 0) t""", "memos"))
def q_text_cache_lookup(spark, sf):
    memos = tables.memos(spark, sf)
    from quire.functions.text import path_key
    cache = memos.where("seq % 3 = 0").select(path_key("file_path").alias("path_md5"), "text")
    texts, _ = D.text_cache_lookup(memos.select("seq", "file_path"), cache,
                                   lambda miss: miss.join(memos.select("seq", "text"), "seq"))
    return texts.select("seq", "path_md5", "text", "from_cache")


@query("truncate_text", S.with_ctes("SELECT seq, substring(text, 1, 10000) AS request_text FROM memos", "memos"))
def q_truncate_text(spark, sf):
    return tables.memos(spark, sf).select("seq", truncate_text("text").alias("request_text"))


@query("error_text", S.with_ctes("SELECT seq, substring(text, 1, 100) AS error_text FROM memos", "memos"))
def q_error_text(spark, sf):
    return tables.memos(spark, sf).select("seq", error_text("text").alias("error_text"))


# ---------------------------------------------------------------- rule tables (parameters of these queries)

# Rules are user input (the reference keeps them in prompt text); these rows are this query's parameters,
# chosen to hit the documents table.  Patterns stay in the regex subset shared by Java and RE2.
DOC_RULES = [
    X.Rule("lic", "license", "false", 1, 4, r"(?i)licen[cs]e"),
    X.Rule("phone", "contact", "n/a", 2, 3, r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}"),
    X.Rule("mail", "contact", "n/a", 2, 3, r"[A-Za-z0-9._-]+@[A-Za-z0-9.-]+\.[a-z]{2,}"),
    X.Rule("en", "english", "true", 3, 1, r"(^|[ .,])[Tt]he[ .,]"),
    X.Rule("de", "german", "true", 4, 1, r"(^|[ .,])[Uu]nd[ .,]"),
    X.Rule("fr", "french", "true", 5, 2, r"(^|[ .,])[Ll]a[ .,]"),
]
CATEGORIES = ["license", "contact", "english", "german", "french"]
FIELD_PATTERNS = [
    X.FieldPattern("email", r"([A-Za-z0-9._-]+@[A-Za-z0-9.-]+\.[a-z]{2,})"),
    X.FieldPattern("phone", r"(\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4})"),
    X.FieldPattern("license", r"((MIT|Apache|GNU)[A-Za-z ]* License)"),
]


def _docs(spark, sf):
    return tables.load(spark, sf, "documents").select("doc_id", "text")


def _match(p: str) -> str:
    return f"regexp_matches(text, '{p}')"


@query("rule_match", " UNION ALL ".join(
    f"SELECT doc_id, '{r.rule_id}' AS rule_id, '{r.grp}' AS grp, '{r.verdict}' AS verdict FROM documents "
    f"WHERE {_match(r.pattern)}" for r in DOC_RULES))
def q_rule_match(spark, sf):
    return X.rule_match(_docs(spark, sf), "text", DOC_RULES, ["doc_id"])


def _first_rule_case(kind: str, default: str) -> str:
    whens = " ".join(f"WHEN {_match(r.pattern)} THEN '{r.verdict if kind == 'v' else 'rule ' + r.rule_id}'"
                     for r in sorted(DOC_RULES, key=lambda r: (r.precedence, r.rule_id)))
    return f"CASE {whens} ELSE '{default}' END"


@query("classify_rules", f"""
SELECT doc_id, {_first_rule_case('v', 'n/a')} AS verdict, {_first_rule_case('r', 'No rule matched')} AS reason
FROM documents""")
def q_classify_rules(spark, sf):
    return X.classify_rules(_docs(spark, sf), "text", DOC_RULES, "n/a").select("doc_id", "verdict", "reason")


def _cat_sql(c: str) -> str:
    pats = [r.pattern for r in DOC_RULES if r.grp == c]
    return "(" + " OR ".join(_match(p) for p in pats) + ")" if pats else "false"


@query("tag_topics", "SELECT doc_id, " + ", ".join(f"{_cat_sql(c)} AS contains_{c}" for c in CATEGORIES)
       + ", concat_ws(',', " + ", ".join(f"CASE WHEN {_cat_sql(c)} THEN '{c}' END" for c in CATEGORIES)
       + ") AS matched_categories FROM documents")
def q_tag_topics(spark, sf):
    return X.tag_topics(_docs(spark, sf), "text", DOC_RULES, CATEGORIES).drop("text")


_SCORE = ("CAST(least(10, greatest(1, " + " + ".join(f"CASE WHEN {_match(r.pattern)} THEN {r.weight} ELSE 0 END"
                                                    for r in DOC_RULES) + ")) AS INTEGER)")


@query("score_and_priority", f"""
SELECT doc_id, score, CASE WHEN score >= 7 THEN 'high' WHEN score >= 4 THEN 'medium' ELSE 'low' END AS priority
FROM (SELECT doc_id, {_SCORE} AS score FROM documents) t""")
def q_score_and_priority(spark, sf):
    return X.score_and_priority(_docs(spark, sf), "text", DOC_RULES).select("doc_id", "score", "priority")


@query("extract_fields", "SELECT doc_id, " + ", ".join(
    f"coalesce(nullif(regexp_extract(text, '{p.pattern}', 1), ''), 'Not found') AS {p.field}"
    for p in FIELD_PATTERNS) + " FROM documents")
def q_extract_fields(spark, sf):
    return X.extract_fields(_docs(spark, sf), "text", FIELD_PATTERNS).drop("text")


# ---------------------------------------------------------------- memo flavour of upsert and ledger

MEMO_UPSERT_COLUMNS = ["second_pass_violations", "second_pass_score", "suggested_remediation", "priority_level"]


@query("upsert_memo_results", _q(f"""
SELECT r.seq, r.memo_id,
       CASE WHEN u.k IS NULL THEN '[]' ELSE CAST(to_json(u.v) AS VARCHAR) END AS second_pass_violations,
       CASE WHEN u.k IS NULL THEN 0 ELSE u.s END AS second_pass_score,
       CASE WHEN u.k IS NULL THEN '' ELSE u.r END AS suggested_remediation,
       CASE WHEN u.k IS NULL THEN '' ELSE u.p END AS priority_level,
       CAST(CASE lower(CASE WHEN u.k IS NULL THEN '' ELSE u.p END)
            WHEN 'high' THEN 0 WHEN 'medium' THEN 1 WHEN 'low' THEN 2 WHEN '' THEN 3 END AS INTEGER) AS priority_rank
FROM ({_decode_sql("m_p1", X.MEMO_PASS1)}) r
LEFT JOIN (SELECT memo_id AS k, arg_max_null(second_pass_violations, seq) AS v, arg_max_null(second_pass_score, seq) AS s,
                  arg_max_null(suggested_remediation, seq) AS r, arg_max_null(priority_level, seq) AS p
           FROM ({_decode_sql("m_p2", X.MEMO_PASS2)}) t
           WHERE memo_id NOT IN ('Not found', 'Error') GROUP BY 1) u ON r.memo_id = u.k"""))
def q_upsert_memo_results(spark, sf):
    """Memo results after pass 2: the four second-pass columns overwritten by the last answer per memo id,
    then the priority review order."""
    base = X.decode_response(memo_p1(spark, sf), "response", X.MEMO_PASS1).select("seq", "memo_id").withColumns({
        "second_pass_violations": F.array().cast("array<string>"), "second_pass_score": F.lit(0),
        "suggested_remediation": F.lit(""), "priority_level": F.lit("")})
    updates = _memo2(spark, sf).withColumnRenamed("seq", "useq")
    out = R.order_by_priority(R.upsert_results(base, updates, key="memo_id", seq="useq",
                                               columns=MEMO_UPSERT_COLUMNS))
    return out.select("seq", "memo_id", list_to_text("second_pass_violations").alias("second_pass_violations"),
                      "second_pass_score", "suggested_remediation", "priority_level", "priority_rank")


@query("append_ledger_memos", _q(f"""
SELECT 'M' || doc_id AS memo_id, '2024-12-31' AS review_date FROM documents WHERE doc_id % 5 = 0
UNION ALL
SELECT DISTINCT memo_id, '{tables.RUN_DATE}' FROM ({_decode_sql("m_p1", X.MEMO_PASS1)}) t
WHERE memo_id IS NOT NULL AND memo_id <> '' AND memo_id NOT IN ('Not found', 'Error')
  AND memo_id NOT IN (SELECT 'M' || doc_id FROM documents WHERE doc_id % 5 = 0)"""))
def q_append_ledger_memos(spark, sf):
    """Memo ledger after a run: every decoded memo id is recorded, whatever its score (the reference's
    behaviour; ``append_ledger(..., predicate=...)`` restricts it)."""
    ledger = tables.load(spark, sf, "documents").where("doc_id % 5 = 0").selectExpr(
        "concat('M', doc_id) as memo_id", "'2024-12-31' as review_date")
    rec = X.decode_response(memo_p1(spark, sf), "response", X.MEMO_PASS1)
    return R.append_ledger(rec, ledger, tables.RUN_DATE, key="memo_id")
