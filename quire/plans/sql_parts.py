"""DuckDB building blocks for the oracle: the adapters as CTEs and the scalar functions as SQL text.

These mirror ``quire.sources.tables`` and ``quire.functions`` expression by expression, in DuckDB's dialect
(``//`` for integral division, ``||`` propagating nulls, ``'g'`` flag for global regex replace).
"""

from __future__ import annotations

from quire.functions.currency import WHITESPACE

_WS_CHARS = "(" + " || ".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"


def strip_ws(e: str) -> str:
    """Same character set as ``quire.functions.currency.WHITESPACE``."""
    return f"trim({e}, {_WS_CHARS})"


def clean_currency(x: str) -> str:
    s = strip_ws(f"replace(replace({strip_ws(f'lower({x})')}, 'usd', ''), '$', '')")
    head = f"replace({strip_ws(f'split_part({s}, {chr(39)}million{chr(39)}, 1)')}, ',', '')"
    number = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"
    plain = r"'^([0-9]+\.?[0-9]*|\.[0-9]+)$'"
    million = f"CASE WHEN regexp_matches({head}, {number}) THEN TRY_CAST({head} AS DOUBLE) * 1000000.0 ELSE 0.0 END"
    m_digits = f"regexp_replace(substring({s}, 1, length({s}) - 1), '[^0-9.]', '', 'g')"
    m_value = f"CASE WHEN regexp_matches({m_digits}, {plain}) THEN TRY_CAST({m_digits} AS DOUBLE) * 1000000.0 ELSE 0.0 END"
    digits = f"regexp_replace({s}, '[^0-9.]', '', 'g')"
    fixed = (f"CASE WHEN strpos({digits}, '.') > 0 THEN split_part({digits}, '.', 1) || '.' || "
             f"replace(substring({digits}, strpos({digits}, '.') + 1), '.', '') ELSE {digits} END")
    plain_v = f"CASE WHEN regexp_matches({fixed}, {plain}) THEN TRY_CAST({fixed} AS DOUBLE) ELSE 0.0 END"
    return (f"(CASE WHEN {x} IS NULL OR {x} = 'Not found' THEN 0.0 "
            f"WHEN strpos({s}, 'million') > 0 THEN {million} "
            f"WHEN suffix({s}, 'm') THEN {m_value} ELSE {plain_v} END)")


def money(e: str) -> str:
    return f"coalesce(TRY_CAST({e} AS DECIMAL(28,2)), 0)"


def format_currency(x: str) -> str:
    cents = f"CAST(CAST({x} AS DECIMAL(38,2)) * 100 AS BIGINT)"
    scaled = (f"(CASE WHEN {cents} >= 100000000000 THEN ({cents} + 500000000) // 1000000000 "
              f"WHEN {cents} >= 100000000 THEN ({cents} + 500000) // 1000000 "
              f"WHEN {cents} >= 100000 THEN ({cents} + 500) // 1000 ELSE {cents} END)")
    sfx = (f"(CASE WHEN {cents} >= 100000000000 THEN 'B' WHEN {cents} >= 100000000 THEN 'M' "
           f"WHEN {cents} >= 100000 THEN 'K' ELSE '' END)")
    mag = f"abs({scaled})"
    return (f"('$' || (CASE WHEN {scaled} < 0 THEN '-' ELSE '' END) || CAST({mag} // 100 AS VARCHAR) || '.' || "
            f"lpad(CAST({mag} % 100 AS VARCHAR), 2, '0') || {sfx})")


def pad_right(e: str, w: int) -> str:
    return f"(CASE WHEN length({e}) < {w} THEN rpad({e}, {w}, ' ') ELSE {e} END)"


def pad_left(e: str, w: int) -> str:
    return f"(CASE WHEN length({e}) < {w} THEN lpad({e}, {w}, ' ') ELSE {e} END)"


def report_line(rank: str, vendor: str, tot: str, fy: str) -> str:
    return (f"concat_ws(' ', {pad_right(f'CAST({rank} AS VARCHAR)', 4)}, {pad_right(f'substring({vendor}, 1, 50)', 50)}, "
            f"{pad_left(tot, 15)}, {pad_left(fy, 15)})")


CONTRACTS = r"""
contracts AS (
  SELECT
    k AS seq,
    'C' || k AS contract_number,
    CASE WHEN k % 3 = 1 AND k > 1 THEN 'C0' WHEN k % 5 <> 0 AND k % 2 = 0 THEN 'C' || (k - k % 5)
         ELSE 'Not found' END AS parent_contract_number,
    'Order ' || k || ' priority ' || o_orderpriority || ' status ' || o_orderstatus AS description,
    CASE WHEN k % 3 = 2 THEN 'Hot Vendor Inc' ELSE c_name END AS vendor_name,
    'Officer ' || (o_custkey % 50) AS contracting_officer,
    CASE k % 8
      WHEN 0 THEN '$' || format('{:,}', d) || '.' || lpad(CAST(c AS VARCHAR), 2, '0')
      WHEN 1 THEN (d // 1000) || '.' || (d % 10) || ' million'
      WHEN 2 THEN (d // 10000) || '.' || (d % 10) || 'M'
      WHEN 3 THEN 'USD ' || d || '.' || lpad(CAST(c AS VARCHAR), 2, '0')
      WHEN 4 THEN 'Not found'
      WHEN 5 THEN CAST(NULL AS VARCHAR)
      WHEN 6 THEN d || '.' || (c // 10) || '.' || (c % 10)
      ELSE '(' || d || ')' END AS total_value,
    CASE (k // 8) % 8
      WHEN 0 THEN '$' || fd || '.' || lpad(CAST(fc AS VARCHAR), 2, '0')
      WHEN 1 THEN '-' || (fd // 1000) || ' million'
      WHEN 2 THEN 'about ' || (fd // 1000) || ' million'
      WHEN 3 THEN fd || 'k'
      WHEN 4 THEN '$ ' || (fd // 1000) || ' m'
      WHEN 5 THEN 'Error'
      WHEN 6 THEN ''
      ELSE (fd // 100000) || '.' || (fd % 10) || ' billion' END AS fy25_value,
    '$' || (d // 3) AS remaining_obligations,
    o_orderstatus = 'O' AS is_idiq,
    k % 7 = 3 AS is_modification,
    '/contracts/' || year(o_orderdate) || '/C' || k || '.pdf' AS file_path,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'true' WHEN '2-HIGH' THEN 'false'
      WHEN '3-MEDIUM' THEN 'N/A' WHEN '4-NOT SPECIFIED' THEN 'Error' ELSE '' END AS first_pass_munchable,
    CASE k % 6 WHEN 0 THEN CAST(NULL AS VARCHAR) WHEN 1 THEN 'nan' WHEN 2 THEN 'finance review'
      ELSE 'rule ' || (k % 6) END AS first_pass_reason,
    CASE WHEN k % 9 = 0 THEN '' WHEN o_orderstatus = 'F' THEN 'true'
      WHEN o_orderstatus = 'O' THEN 'false' ELSE 'n/a' END AS second_pass_munchable,
    CASE k % 4 WHEN 0 THEN CAST(NULL AS VARCHAR) WHEN 1 THEN 'nan'
      ELSE 'second look ' || (k % 4) END AS second_pass_reason
  FROM (
    SELECT *, cents // 100 AS d, cents % 100 AS c, (cents // 4) // 100 AS fd, (cents // 4) % 100 AS fc
    FROM (
      SELECT o.o_orderkey AS k, o.o_custkey, o.o_orderstatus, o.o_orderdate, o.o_orderpriority, cu.c_name,
             CAST(floor(o.o_totalprice * 100 + 0.5) AS BIGINT) AS cents
      FROM orders o LEFT JOIN customer cu ON o.o_custkey = cu.c_custkey) b0) b1
)"""

CONTRACTS_CLEAN = f"""
contracts_clean AS (
  SELECT * REPLACE ({money(clean_currency('total_value'))} AS total_value,
                    {money(clean_currency('fy25_value'))} AS fy25_value)
  FROM contracts
)"""

POSITIONS = r"""
positions AS (
  SELECT
    c_custkey AS seq,
    CASE WHEN c_custkey % 97 = 96 THEN CAST(c_custkey AS VARCHAR)
         WHEN c_custkey % 101 = 100 THEN ''
         WHEN c_custkey % 13 = 5 THEN ' ' || (c_custkey + 1) || ' '
         ELSE CAST(c_custkey + 1 AS VARCHAR) END AS "Position Number",
    CASE WHEN c_custkey = 1 THEN '14'
         WHEN c_custkey = 2 THEN '3'
         WHEN c_custkey % 3 = 0 AND c_custkey > 0 THEN '1'
         WHEN (c_custkey + 1) // 7 = 0 THEN ''
         WHEN c_custkey % 17 = 4 THEN ' ' || ((c_custkey + 1) // 7)
         ELSE CAST((c_custkey + 1) // 7 AS VARCHAR) END AS "Reports To Position Number",
    'Title ' || (c_custkey % 9) AS "Official Position Title",
    CASE c_nationkey % 4 WHEN 0 THEN 'VHA' WHEN 1 THEN 'VACO' WHEN 2 THEN 'VBA' ELSE 'NCA' END AS "Admin",
    CASE WHEN c_custkey % 53 = 7 THEN ''
         WHEN c_custkey % 11 = 0 THEN lower(c_mktsegment)
         WHEN c_custkey % 19 = 3 THEN c_mktsegment || ' & Co.'
         ELSE c_mktsegment END AS "Cost Center Desc",
    'Dept ' || c_nationkey AS "Dept Desc",
    CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'Org ' || (c_custkey % 5) END AS "Org Code Desc",
    CASE WHEN (c_custkey + 1) // 7 = 0 THEN 'Executive' ELSE 'Staff' END AS "Supervisory Level Desc",
    coalesce(n_name, '') AS "Location Desc"
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
)"""

MEMOS = """
memos AS (
  SELECT doc_id AS seq, 'M' || doc_id AS memo_id, text, lang, source,
         '/memos/' || source || '/M' || doc_id || '.pdf' AS file_path
  FROM documents
)"""

PAGE_TEXTS = """
page_texts AS (
  SELECT 'D' || conv_id AS doc_id, CAST(turn AS INTEGER) AS page_no, text AS page_text, role <> 'system' AS ok
  FROM conversations
)"""

_INV_NAME = ("'docs/' || p_brand || '/' || p_partkey || CASE WHEN p_partkey % 7 = 0 THEN '.txt' "
             "WHEN p_partkey % 3 = 0 THEN '.PDF' ELSE '.pdf' END")

REMOTE_INVENTORY = f"""
remote_inventory AS (
  SELECT {_INV_NAME} AS name, CAST(p_size AS BIGINT) * 1000 + p_partkey % 10 AS size,
         make_timestamp(1700000000000000 + p_partkey * 60000000) AS last_modified
  FROM part
)"""

LOCAL_INVENTORY = f"""
local_inventory AS (
  SELECT {_INV_NAME} AS name,
         CAST(p_size AS BIGINT) * 1000 + p_partkey % 10 + CASE WHEN p_partkey % 4 = 1 THEN 1 ELSE 0 END AS size
  FROM part WHERE p_partkey % 4 < 2
)"""

PASS1_RECORDS = """
pass1_records AS (
  SELECT * REPLACE (CASE seq % 10 WHEN 7 THEN 'Not found' WHEN 9 THEN 'Error'
                    WHEN 3 THEN 'C' || (seq - 1) ELSE contract_number END AS contract_number)
  FROM contracts
)"""

REVIEWED_LEDGER = """
reviewed_ledger AS (SELECT contract_number, '2024-12-31' AS review_date FROM pass1_records WHERE seq % 3 = 0)"""

PROCESSED_LOG = """
processed_log AS (SELECT file_path AS path, CASE WHEN seq % 8 = 4 THEN 'retry' ELSE 'ok' END AS status
                  FROM contracts WHERE seq % 4 = 0)"""

PASS2_ANSWERS = """
pass2_answers AS (
  SELECT contract_number AS request_id,
         CASE WHEN seq % 30 = 1 THEN 'Not found' ELSE contract_number END AS contract_number,
         'TRUE' AS second_pass_munchable, 'first answer' AS second_pass_reason,
         first_pass_munchable, first_pass_reason, seq * 2 AS aseq
  FROM contracts
  UNION ALL
  SELECT contract_number,
         CASE WHEN seq % 30 = 1 THEN 'Not found' ELSE contract_number END,
         CASE seq % 5 WHEN 0 THEN 'False' WHEN 1 THEN 'N/A' WHEN 2 THEN 'Error' ELSE 'true' END,
         CASE seq % 3 WHEN 0 THEN 'nan' WHEN 1 THEN CAST(NULL AS VARCHAR) ELSE 'final answer' END,
         first_pass_munchable, first_pass_reason, seq * 2 + 1
  FROM contracts WHERE seq % 3 <> 2
)"""

CTES = {
    "contracts": CONTRACTS,
    "contracts_clean": CONTRACTS_CLEAN,
    "positions": POSITIONS,
    "memos": MEMOS,
    "page_texts": PAGE_TEXTS,
    "remote_inventory": REMOTE_INVENTORY,
    "local_inventory": LOCAL_INVENTORY,
    "pass1_records": PASS1_RECORDS,
    "reviewed_ledger": REVIEWED_LEDGER,
    "processed_log": PROCESSED_LOG,
    "pass2_answers": PASS2_ANSWERS,
}

_DEPENDS = {"contracts_clean": ["contracts"], "pass1_records": ["contracts"],
            "reviewed_ledger": ["contracts", "pass1_records"], "processed_log": ["contracts"],
            "pass2_answers": ["contracts"]}


def with_ctes(body: str, *names: str, extra: list[str] | None = None, recursive: bool = False) -> str:
    """``WITH <adapters> [, extra CTEs] <body>``; dependencies are pulled in first."""
    order: list[str] = []
    for n in names:
        for d in _DEPENDS.get(n, []):
            if d not in order:
                order.append(d)
        if n not in order:
            order.append(n)
    parts = [CTES[n].strip() for n in order] + [e.strip() for e in (extra or [])]
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" + body
