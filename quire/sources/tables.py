"""Driver tables and the adapters that shape them into the library's record types.

Every adapter is a projection / join over the given parquet tables, so its size grows with them.  The
expressions are deterministic, so the DuckDB oracle (``quire.plans.sql_parts``) rebuilds the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import broadcast_if_small

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def spread(df: DataFrame) -> DataFrame:
    """Round-robin the rows over the cluster's cores when a scan plans fewer partitions than that.

    A single-row-group file is read by one task, which would run every per-row text / regex operator
    serially.  At cluster scale a table spans many files and plans far more partitions than cores, so this is
    a no-op there.  Filters and column pruning still push through the repartition into the scan."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def load(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = True) -> DataFrame:
    """A driver table; ``spread_rows=False`` for lookup sides of joins (no point spreading what is hashed or
    broadcast as a whole)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if spread_rows else df


# ---------------------------------------------------------------- contracts (orders x customer)

_MONEY_CENTS = "cast(floor(o_totalprice * 100 + 0.5) as bigint)"

CONTRACT_COLUMNS = [
    "seq", "contract_number", "parent_contract_number", "description", "vendor_name", "contracting_officer",
    "total_value", "fy25_value", "remaining_obligations", "is_idiq", "is_modification", "file_path",
    "first_pass_munchable", "first_pass_reason", "second_pass_munchable", "second_pass_reason",
]


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One contract result row per order (``o_orderkey`` is unique); vendor = customer name.

    Money columns are text in the messy shapes the cleaner has to handle; parents exist for joins.  Hot keys
    on purpose: a third of all contracts are children of ``C0`` and a third belong to one vendor.
    """
    o = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = load(spark, sf_dir, "customer", spread_rows=False).select("c_custkey", "c_name")
    base = o.join(c, o.o_custkey == c.c_custkey, "left").selectExpr(
        "o_orderkey as k", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "c_name",
        f"{_MONEY_CENTS} as cents")
    base = base.selectExpr("*", "cents div 100 as d", "cents % 100 as c", "(cents div 4) div 100 as fd",
                           "(cents div 4) % 100 as fc")
    return base.selectExpr(
        "k as seq",
        "concat('C', k) as contract_number",
        "case when k % 3 = 1 and k > 1 then 'C0' when k % 5 <> 0 and k % 2 = 0 then concat('C', k - k % 5) "
        "else 'Not found' end as parent_contract_number",
        "concat('Order ', k, ' priority ', o_orderpriority, ' status ', o_orderstatus) as description",
        "case when k % 3 = 2 then 'Hot Vendor Inc' else c_name end as vendor_name",
        "concat('Officer ', o_custkey % 50) as contracting_officer",
        """case k % 8
             when 0 then concat('$', format_number(d, 0), '.', lpad(cast(c as string), 2, '0'))
             when 1 then concat(d div 1000, '.', d % 10, ' million')
             when 2 then concat(d div 10000, '.', d % 10, 'M')
             when 3 then concat('USD ', d, '.', lpad(cast(c as string), 2, '0'))
             when 4 then 'Not found'
             when 5 then cast(null as string)
             when 6 then concat(d, '.', c div 10, '.', c % 10)
             else concat('(', d, ')') end as total_value""",
        """case (k div 8) % 8
             when 0 then concat('$', fd, '.', lpad(cast(fc as string), 2, '0'))
             when 1 then concat('-', fd div 1000, ' million')
             when 2 then concat('about ', fd div 1000, ' million')
             when 3 then concat(fd, 'k')
             when 4 then concat('$ ', fd div 1000, ' m')
             when 5 then 'Error'
             when 6 then ''
             else concat(fd div 100000, '.', fd % 10, ' billion') end as fy25_value""",
        "concat('$', d div 3) as remaining_obligations",
        "o_orderstatus = 'O' as is_idiq",
        "k % 7 = 3 as is_modification",
        "concat('/contracts/', year(o_orderdate), '/C', k, '.pdf') as file_path",
        """case o_orderpriority when '1-URGENT' then 'true' when '2-HIGH' then 'false'
             when '3-MEDIUM' then 'N/A' when '4-NOT SPECIFIED' then 'Error' else '' end as first_pass_munchable""",
        """case k % 6 when 0 then cast(null as string) when 1 then 'nan' when 2 then 'finance review'
             else concat('rule ', k % 6) end as first_pass_reason""",
        """case when k % 9 = 0 then '' when o_orderstatus = 'F' then 'true'
             when o_orderstatus = 'O' then 'false' else 'n/a' end as second_pass_munchable""",
        """case k % 4 when 0 then cast(null as string) when 1 then 'nan'
             else concat('second look ', k % 4) end as second_pass_reason""",
    )


# ---------------------------------------------------------------- positions (customer x nation)

POSITION_COLUMNS = ["seq", "Position Number", "Reports To Position Number", "Official Position Title", "Admin",
                    "Cost Center Desc", "Dept Desc", "Org Code Desc", "Supervisory Level Desc", "Location Desc"]


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Org rows, all strings: id = custkey + 1, supervisor = id div 7 (0 -> blank = root).

    Injected cases: duplicate ids (custkey % 97 = 96 repeats the previous id), blank ids, padded ids and
    supervisors, a 2-cycle (2 <-> 14), a self-loop (3), supervisors that are no position, case variants
    and blanks in the cost center, and a hot manager: a third of all positions report to position 1.
    """
    cu = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    na = broadcast_if_small(load(spark, sf_dir, "nation", spread_rows=False).select("n_nationkey", "n_name"), 10_000)
    j = cu.join(na, cu.c_nationkey == na.n_nationkey, "left")
    return j.selectExpr(
        "c_custkey as seq",
        """case when c_custkey % 97 = 96 then cast(c_custkey as string)
                when c_custkey % 101 = 100 then ''
                when c_custkey % 13 = 5 then concat(' ', c_custkey + 1, ' ')
                else cast(c_custkey + 1 as string) end as `Position Number`""",
        """case when c_custkey = 1 then '14'
                when c_custkey = 2 then '3'
                when c_custkey % 3 = 0 and c_custkey > 0 then '1'
                when (c_custkey + 1) div 7 = 0 then ''
                when c_custkey % 17 = 4 then concat(' ', (c_custkey + 1) div 7)
                else cast((c_custkey + 1) div 7 as string) end as `Reports To Position Number`""",
        "concat('Title ', c_custkey % 9) as `Official Position Title`",
        "case c_nationkey % 4 when 0 then 'VHA' when 1 then 'VACO' when 2 then 'VBA' else 'NCA' end as `Admin`",
        """case when c_custkey % 53 = 7 then ''
                when c_custkey % 11 = 0 then lower(c_mktsegment)
                when c_custkey % 19 = 3 then concat(c_mktsegment, ' & Co.')
                else c_mktsegment end as `Cost Center Desc`""",
        "concat('Dept ', c_nationkey) as `Dept Desc`",
        "case when c_custkey % 2 = 0 then '' else concat('Org ', c_custkey % 5) end as `Org Code Desc`",
        "case when (c_custkey + 1) div 7 = 0 then 'Executive' else 'Staff' end as `Supervisory Level Desc`",
        "coalesce(n_name, '') as `Location Desc`",
    )


# ---------------------------------------------------------------- memos, pages, inventories

def memos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One memo per document; the whole text is kept."""
    return load(spark, sf_dir, "documents").selectExpr(
        "doc_id as seq", "concat('M', doc_id) as memo_id", "text", "lang", "source",
        "concat('/memos/', source, '/M', doc_id, '.pdf') as file_path")


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as ordered pages of a document; system turns play failed pages."""
    return load(spark, sf_dir, "conversations").selectExpr(
        "concat('D', conv_id) as doc_id", "cast(turn as int) as page_no", "text as page_text",
        "role <> 'system' as ok")


def remote_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remote blob listing: name, size, last_modified; some names are not PDFs or use upper case."""
    return load(spark, sf_dir, "part").selectExpr(
        """concat('docs/', p_brand, '/', p_partkey,
                  case when p_partkey % 7 = 0 then '.txt' when p_partkey % 3 = 0 then '.PDF' else '.pdf' end)
           as name""",
        "cast(p_size as bigint) * 1000 + p_partkey % 10 as size",
        "timestamp_seconds(1700000000 + p_partkey * 60) as last_modified")


def local_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local copy state derived from the same parts: same size, other size, or absent."""
    return (load(spark, sf_dir, "part")
            .where("p_partkey % 4 < 2")
            .selectExpr(
                """concat('docs/', p_brand, '/', p_partkey,
                          case when p_partkey % 7 = 0 then '.txt' when p_partkey % 3 = 0 then '.PDF' else '.pdf' end)
                   as name""",
                "cast(p_size as bigint) * 1000 + p_partkey % 10 + case when p_partkey % 4 = 1 then 1 else 0 end as size"))


# ---------------------------------------------------------------- ledgers and pass-2 answers (from contracts)

RUN_DATE = "2025-01-01"


def pass1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-pass records as decoded from the model: some ids are sentinels, some repeat the previous id."""
    return contracts(spark, sf_dir).withColumn("contract_number", F.expr(
        """case seq % 10 when 7 then 'Not found' when 9 then 'Error'
                         when 3 then concat('C', seq - 1) else contract_number end"""))


def reviewed_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of reviewed ids as left by earlier runs (includes sentinel rows written by an older version)."""
    return pass1_records(spark, sf_dir).where("seq % 3 = 0").selectExpr(
        "contract_number", "'2024-12-31' as review_date")


def processed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed-file ledger: done paths, some marked for retry."""
    return contracts(spark, sf_dir).where("seq % 4 = 0").selectExpr(
        "file_path as path", "case when seq % 8 = 4 then 'retry' else 'ok' end as status")


def pass2_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two second-pass answers per contract (the later one wins); the echoed id is sometimes a sentinel."""
    c = contracts(spark, sf_dir).select("seq", "contract_number", "first_pass_munchable", "first_pass_reason")
    first = c.selectExpr(
        "contract_number as request_id",
        "case when seq % 30 = 1 then 'Not found' else contract_number end as contract_number",
        "'TRUE' as second_pass_munchable", "'first answer' as second_pass_reason",
        "first_pass_munchable", "first_pass_reason", "seq * 2 as aseq")
    second = c.where("seq % 3 <> 2").selectExpr(
        "contract_number as request_id",
        "case when seq % 30 = 1 then 'Not found' else contract_number end as contract_number",
        "case seq % 5 when 0 then 'False' when 1 then 'N/A' when 2 then 'Error' else 'true' end "
        "as second_pass_munchable",
        "case seq % 3 when 0 then 'nan' when 1 then cast(null as string) else 'final answer' end "
        "as second_pass_reason",
        "first_pass_munchable", "first_pass_reason", "seq * 2 + 1 as aseq")
    return first.unionByName(second)
