"""Org-table and hierarchy queries over the positions adapter (customer x nation)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quire.functions.text import export_name, safe_dir_name, trim_id
from quire.operators import hierarchy as H
from quire.operators import org
from quire.plans import sql_parts as S
from quire.plans.registry import REGISTRY, query
from quire.session import checkpoint_dir
from quire.sources import tables

ROOT = "1"
FILTERS = {"admin": "vba", "location": "nation_6"}
EXPORT_FILTERS = {"admin": "vba"}
RUN_TS = "20250101_000000"
POS_COLS = [c for c in tables.POSITION_COLUMNS if c != "seq"]


def scratch(spark, what: str) -> str:
    """Fresh folder under the session's shared checkpoint folder (never a machine-local temp dir)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/scratch/{what}-{uuid.uuid4().hex}"


def trim_sql(e: str) -> str:
    return S.strip_ws(e)


NODES = f"""
nodes AS (SELECT DISTINCT {trim_sql('"Position Number"')} AS id FROM positions
          WHERE {trim_sql('"Position Number"')} <> '')"""
EDGES = f"""
edges AS (SELECT * FROM (SELECT {trim_sql('"Reports To Position Number"')} AS parent,
                                {trim_sql('"Position Number"')} AS child FROM positions) e
          WHERE child <> '' AND parent <> '')"""
VALID = """
valid AS (SELECT parent, child FROM edges
          WHERE child IN (SELECT id FROM nodes) AND parent IN (SELECT id FROM nodes))"""
SUB = f"""
sub(id) AS (SELECT id FROM nodes WHERE id = '{ROOT}'
            UNION SELECT v.child FROM valid v JOIN sub ON v.parent = sub.id)"""
# Heights: a node resolves iff it cannot reach a cycle; resolved height = longest path to a leaf.
HEIGHT_CTES = [NODES, EDGES, VALID, """
reach(anc, des) AS (SELECT parent, child FROM valid
                    UNION SELECT r.anc, v.child FROM reach r JOIN valid v ON v.parent = r.des)""", """
bad AS (SELECT anc AS id FROM reach WHERE anc = des
        UNION SELECT r.anc FROM reach r JOIN reach c ON r.des = c.anc AND c.anc = c.des)""", """
good AS (SELECT parent, child FROM valid WHERE parent NOT IN (SELECT id FROM bad))""", """
paths(anc, des, len) AS (SELECT parent, child, 1 FROM good
                         UNION SELECT p.anc, g.child, p.len + 1 FROM paths p JOIN good g ON g.parent = p.des)""", """
hgood AS (SELECT n.id, coalesce(max(p.len), 0) AS h FROM nodes n LEFT JOIN paths p ON p.anc = n.id
          WHERE n.id NOT IN (SELECT id FROM bad) GROUP BY n.id)""", """
heights AS (
  SELECT id, CAST(h AS INTEGER) AS height, true AS resolved FROM hgood
  UNION ALL
  SELECT b.id, CAST(coalesce(max(hg.h) + 1, -1) AS INTEGER), false
  FROM (SELECT DISTINCT id FROM bad) b LEFT JOIN valid v ON v.parent = b.id LEFT JOIN hgood hg ON hg.id = v.child
  GROUP BY b.id)"""]


def _pos(spark, sf):
    return tables.positions(spark, sf)


def _graph(spark, sf):
    p = _pos(spark, sf)
    n = H.nodes(p)
    return p, n, H.edge_validity(H.build_edges(p), n)


def _pos_sel(df):
    return df.select("seq", F.col("`Position Number`").alias("position_raw"))


@query("scan_positions", S.with_ctes(
    "SELECT " + ", ".join(f'"{c}"' for c in POS_COLS) + " FROM positions", "positions"),
    note="CSV round trip through the shared scratch folder")
def q_scan_positions(spark, sf):
    path = scratch(spark, "positions-csv")
    (_pos(spark, sf).drop("seq").write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return org.scan_positions(spark, path).drop("seq")


@query("skip_blank_ids", S.with_ctes(f"""
SELECT seq, {trim_sql('"Position Number"')} AS position_number FROM positions
WHERE {trim_sql('"Position Number"')} <> ''""", "positions"))
def q_skip_blank_ids(spark, sf):
    return org.skip_blank_ids(_pos(spark, sf)).select("seq", "position_number")


@query("trim_ids", S.with_ctes(f"""
SELECT seq, {trim_sql('"Position Number"')} AS position_number,
       {trim_sql('"Reports To Position Number"')} AS reports_to FROM positions""", "positions"))
def q_trim_ids(spark, sf):
    return _pos(spark, sf).select("seq", trim_id(F.col("`Position Number`")).alias("position_number"),
                                  trim_id(F.col("`Reports To Position Number`")).alias("reports_to"))


@query("match_filters", S.with_ctes("""
SELECT seq, "Position Number" AS position_raw FROM positions
WHERE lower("Admin") = 'vba' AND lower("Location Desc") = 'nation_6'""", "positions"))
def q_match_filters(spark, sf):
    p = _pos(spark, sf)
    return _pos_sel(p.where(org.match_filters(p, FILTERS)))


@query("dedupe_positions_last", S.with_ctes(f"""
SELECT position_number, position_title, {trim_sql('reports_to')} AS reports_to, admin, cost_center_desc, dept_desc,
       org_code_desc, supervisory_level_desc, location_desc
FROM (SELECT {trim_sql('"Position Number"')} AS position_number,
             arg_max_null("Official Position Title", seq) AS position_title,
             arg_max_null("Reports To Position Number", seq) AS reports_to, arg_max_null("Admin", seq) AS admin,
             arg_max_null("Cost Center Desc", seq) AS cost_center_desc, arg_max_null("Dept Desc", seq) AS dept_desc,
             arg_max_null("Org Code Desc", seq) AS org_code_desc,
             arg_max_null("Supervisory Level Desc", seq) AS supervisory_level_desc,
             arg_max_null("Location Desc", seq) AS location_desc
      FROM positions WHERE {trim_sql('"Position Number"')} <> '' GROUP BY 1) d""", "positions"))
def q_dedupe_positions_last(spark, sf):
    return org.dedupe_positions_last(_pos(spark, sf))


@query("dedupe_positions_files", REGISTRY["dedupe_positions_last"].sql, note="last row wins over several files read back")
def q_dedupe_positions_files(spark, sf):
    path = scratch(spark, "positions-files")
    (_pos(spark, sf).repartitionByRange(5, "seq").sortWithinPartitions("seq").drop("seq").write.option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return org.dedupe_positions_last(org.scan_positions(spark, path))


@query("group_members", S.with_ctes(f"""
SELECT DISTINCT lower("Cost Center Desc") AS cc_key, {trim_sql('"Position Number"')} AS position_number
FROM positions WHERE {trim_sql('"Position Number"')} <> '' AND "Cost Center Desc" <> ''""", "positions"))
def q_group_members(spark, sf):
    return org.group_members(_pos(spark, sf))


_GROUPS_SQL = f"""
SELECT lower("Cost Center Desc") AS cc_key, arg_min_null("Cost Center Desc", seq) AS cost_center_desc,
       count(*) AS n_positions
FROM positions WHERE {trim_sql('"Position Number"')} <> '' AND "Cost Center Desc" <> '' GROUP BY 1"""


def _safe_sql(e):
    return (f"(CASE WHEN regexp_replace(coalesce({e}, ''), '[^\\p{{L}}\\p{{N}}]', '_', 'g') = '' "
            f"THEN 'unknown_cost_center' ELSE regexp_replace(coalesce({e}, ''), '[^\\p{{L}}\\p{{N}}]', '_', 'g') END)")


@query("group_positions", S.with_ctes(f"""
SELECT cc_key, cost_center_desc, CAST(n_positions AS BIGINT) AS n_positions, {_safe_sql('cost_center_desc')} AS safe_cc
FROM ({_GROUPS_SQL}) g""", "positions"))
def q_group_positions(spark, sf):
    return org.group_positions(_pos(spark, sf))


@query("sorted_groups", S.with_ctes(f"""
SELECT cost_center_desc, {_safe_sql('cost_center_desc')} AS safe_cc FROM ({_GROUPS_SQL}) g
ORDER BY cost_center_desc""", "positions"))
def q_sorted_groups(spark, sf):
    return org.group_positions(_pos(spark, sf)).select("cost_center_desc", "safe_cc").orderBy("cost_center_desc")


@query("safe_dir_name", S.with_ctes(f"""
SELECT DISTINCT "Cost Center Desc" AS cost_center_desc, {_safe_sql('"Cost Center Desc"')} AS safe_cc
FROM positions""", "positions"))
def q_safe_dir_name(spark, sf):
    p = _pos(spark, sf)
    return p.select(F.col("`Cost Center Desc`").alias("cost_center_desc"),
                    safe_dir_name(F.col("`Cost Center Desc`")).alias("safe_cc")).distinct()


@query("export_name", S.with_ctes(f"""
SELECT cost_center_desc, 'org_data_cc_' || {_safe_sql('cost_center_desc')} || '_{RUN_TS}.csv' AS file_name
FROM ({_GROUPS_SQL}) g""", "positions"))
def q_export_name(spark, sf):
    g = org.group_positions(_pos(spark, sf))
    return g.select("cost_center_desc", export_name("org_data_cc", F.col("safe_cc"), RUN_TS).alias("file_name"))


@query("load_summary", S.with_ctes(f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(DISTINCT CASE WHEN {trim_sql('"Position Number"')} <> '' THEN {trim_sql('"Position Number"')} END)
            AS BIGINT) AS n_positions,
       CAST(count(DISTINCT CASE WHEN {trim_sql('"Position Number"')} <> '' AND "Cost Center Desc" <> ''
                                THEN lower("Cost Center Desc") END) AS BIGINT) AS n_cost_centers
FROM positions""", "positions"))
def q_load_summary(spark, sf):
    return org.load_summary(_pos(spark, sf))


_EXPORT_SQL = f"""
SELECT {", ".join(f'p."{c}"' for c in POS_COLS)}, {_safe_sql('g.cost_center_desc')} AS safe_cc
FROM positions p JOIN ({_GROUPS_SQL}) g ON lower(p."Cost Center Desc") = g.cc_key
WHERE lower(p."Admin") = 'vba'"""


@query("partitioned_export", S.with_ctes(_EXPORT_SQL, "positions"),
       note="written with partitionBy(safe_cc) to the shared scratch folder and read back")
def q_partitioned_export(spark, sf):
    path = scratch(spark, "cc-export")
    org.partitioned_export(_pos(spark, sf), path, EXPORT_FILTERS)
    schema = ", ".join(f"`{c}` string" for c in POS_COLS) + ", safe_cc string"
    return (spark.read.schema(schema).option("header", True).csv(path).na.fill(""))


@query("build_edges", S.with_ctes("SELECT parent, child FROM edges", "positions", extra=[EDGES]))
def q_build_edges(spark, sf):
    return H.build_edges(_pos(spark, sf))


@query("edge_validity", S.with_ctes("SELECT parent, child FROM valid", "positions", extra=[NODES, EDGES, VALID]))
def q_edge_validity(spark, sf):
    return _graph(spark, sf)[2]


@query("subtree", S.with_ctes("SELECT id FROM sub", "positions", extra=[NODES, EDGES, VALID, SUB],
                              recursive=True))
def q_subtree(spark, sf):
    _, n, e = _graph(spark, sf)
    return H.subtree(e, n, ROOT)


@query("subtree_semi", S.with_ctes(f"""
SELECT seq, "Position Number" AS position_raw FROM positions
WHERE {trim_sql('"Position Number"')} IN (SELECT id FROM sub)""", "positions",
    extra=[NODES, EDGES, VALID, SUB], recursive=True))
def q_subtree_semi(spark, sf):
    p, n, e = _graph(spark, sf)
    return _pos_sel(H.subtree_rows(p, H.subtree(e, n, ROOT)))


@query("subtree_export", S.with_ctes(f"""
SELECT seq, "Position Number" AS position_raw FROM positions
WHERE {trim_sql('"Position Number"')} IN (SELECT id FROM sub) AND lower("Admin") = 'vba'""", "positions",
    extra=[NODES, EDGES, VALID, SUB], recursive=True))
def q_subtree_export(spark, sf):
    """Written as a CSV folder with its export name and read back."""
    p, n, e = _graph(spark, sf)
    rows = H.subtree_rows(p, H.subtree(e, n, ROOT), org.match_filters(p, EXPORT_FILTERS))
    path = org.write_subtree(rows.withColumnRenamed("seq", "row"), scratch(spark, "subtree"), ROOT, EXPORT_FILTERS)
    back = org.scan_positions(spark, path)
    return back.select(F.col("row").cast("long").alias("seq"), F.col("`Position Number`").alias("position_raw"))


CRITERION = ("cost_center", "Nation 6/East")


@query("subtree_export_criterion", S.with_ctes(f"""
SELECT seq, "Position Number" AS position_raw, 'org_chart_cost_center_Nation_6_East_{ROOT}_admin_vba_{RUN_TS}' AS folder,
       'org_data_cost_center_Nation_6_East_{ROOT}_admin_vba_{RUN_TS}.csv' AS file FROM positions
WHERE {trim_sql('"Position Number"')} IN (SELECT id FROM sub) AND lower("Admin") = 'vba'""", "positions",
    extra=[NODES, EDGES, VALID, SUB], recursive=True), note="the criterion stands in the names of the folder and of the file")
def q_subtree_export_criterion(spark, sf):
    p, n, e = _graph(spark, sf)
    rows = H.subtree_rows(p, H.subtree(e, n, ROOT), org.match_filters(p, EXPORT_FILTERS))
    path = org.write_subtree(rows.withColumnRenamed("seq", "row"), scratch(spark, "subtree"), ROOT, EXPORT_FILTERS, CRITERION, RUN_TS)
    back = org.scan_positions(spark, path).withColumn("parts", F.split(F.input_file_name(), "/"))
    return back.select(F.col("row").cast("long").alias("seq"), F.col("`Position Number`").alias("position_raw"),
                       F.element_at("parts", -3).alias("folder"), F.element_at("parts", -2).alias("file"))


@query("height_under", S.with_ctes("SELECT id, height, resolved FROM heights", "positions",
                                   extra=HEIGHT_CTES, recursive=True))
def q_height_under(spark, sf):
    _, n, e = _graph(spark, sf)
    return H.height_under(e, n)


@query("cycle_report", S.with_ctes("""
SELECT CAST(count(*) FILTER (WHERE NOT resolved) AS BIGINT) AS n_unresolved, CAST(count(*) AS BIGINT) AS n_positions
FROM heights""", "positions", extra=HEIGHT_CTES, recursive=True))
def q_cycle_report(spark, sf):
    _, n, e = _graph(spark, sf)
    return H.cycle_report(H.height_under(e, n))
