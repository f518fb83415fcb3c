"""The registered queries of this subpackage and, where SQL can express them, their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import (divergence, mixing, ngram_lm, packing, passages, radix, repetition, run_index, set_join, strata_search,
                       templates, toxicity, url_rules)
from quire.llm.store import table

URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]
LM_ORDER = 3
TOXIC_TRAIN = "crc32(cast(doc_id as string)) % 5 != 0"
MIX_WEIGHTS, MIX_SHARE, MIX_COPIES = [3.0, 1.0, 2.0], 1.5, 2


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


OP1_SQL = """
with u as (select page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path from pages),
r(h, p, v) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                      ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m as (select page_id, max_by(h || p, length(h || p)) as rule, max_by(v, length(h || p)) as verdict
      from u join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by page_id)
select u.page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from u left join m using (page_id)
"""


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.similar_groups(table(spark, sf_dir, "documents"), set_join.Similarity(k=3, num=90, den=100)).drop("th")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(table(spark, sf_dir, "documents"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(table(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_SHARE, MIX_COPIES)
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    model = ngram_lm.train(docs.where(~held).select("text"), order=LM_ORDER)
    return ngram_lm.score(docs, model, {"doc_id": F.col("doc_id"), "held_out": held})


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scorer = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), TOXIC_TRAIN)
    held = F.coalesce(F.crc32(F.col("row.doc_id").cast("string")) % 5 == 0, F.lit(False))
    return scorer.score(docs).select("row.doc_id", held.alias("held_out"), "score", "predicted")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.extract_main_text(table(spark, sf_dir, "pages"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix.exact_groups(table(spark, sf_dir, "documents")).drop("row")


OP10_SQL = """
with d as (select doc_id, coalesce(text, '') as text from documents),
g as (select text, max(doc_id) as keep_id, count(*) as group_size from d group by text)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(text) as text_sha256 from d join g using (text)
"""


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


OP11_SQL = """
with d as (select row_number() over () as nr, coalesce(text, '') as text, coalesce(lang, '') as lang,
                  coalesce(source, '') as source from documents),
w as (select nr, lang, source, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')),
                                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from d),
k as (select lang, t, count(*) as n from w group by lang, t having count(distinct nr) >= 10),
g as (select distinct lang, source from d),
o as (select lang, source, t, count(*) as n from w group by lang, source, t),
c as (select g.lang, g.source, k.t, coalesce(o.n, 0) as n from g join k on k.lang = g.lang
      left join o on o.lang = g.lang and o.source = g.source and o.t = k.t),
p as (select lang, source, t, n, 1 + (1000000000::hugeint * (n + 2)) // (sum(n) over s + 2 * count(*) over s) as p
      from c window s as (partition by lang, source)),
l as (select lang, t, 1 + (1000000000::hugeint * (n + 2)) // (sum(n) over s + 2 * count(*) over s) as q
      from k window s as (partition by lang)),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item,
                 (select coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0) from p x join p y using (lang, t)
                  where x.lang = a.lang and x.source = a.source and y.source = b.source) as value
          from g a join g b on a.lang = b.lang and a.source != b.source),
terms as (select p.lang, p.source, 'term' as part, p.t as item, ((p - q) * (p - q)) // (p + q) as value
          from p join l on l.lang = p.lang and l.t = p.t where n > 0 and p > q),
r as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
      from (select * from pairs union all select * from terms))
select lang, source, part, item, value::bigint as value, rank::int as rank from r where part = 'pair' or rank <= 10
"""


def op12_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = run_index.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


OP12_SQL = """
with d as (select row_number() over (order by doc_id nulls first) as nr, doc_id, encode(coalesce(text, '')) as b from documents),
w as (select nr, i, b[i:i + 99] as s from (select nr, b, unnest(range(1, octet_length(b) - 98)) as i from d)),
f as (select nr, i, (nr, i) > min((nr, i)) over (partition by s) as again from w),
m as (select nr, i, coalesce(i > lag(i) over (partition by nr order by i) + 100, true) as fresh from f where again),
g as (select nr, i, count_if(fresh) over (partition by nr order by i) as span from m),
sp as (select nr, span, min(i) as a, max(i) + 100 as z from g group by nr, span),
k as (select nr, a, z, lag(z, 1, 1) over (partition by nr order by a) as since from sp),
r as (select nr, sum(z - a)::bigint as n_removed, count(*) as n_spans, max(z) as z,
             string_agg(substr(hex(b), 2 * since - 1, 2 * (a - since)), '' order by a) as head
      from k join d using (nr) group by nr)
select doc_id, octet_length(b) as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(head, '') || substr(hex(b), 2 * coalesce(z, 1) - 1))) as kept_sha256
from d left join r using (nr)
"""


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = strata_search.build_index(table(spark, sf_dir, "documents"))
    return strata_search.search(index, table(spark, sf_dir, "benchmark"))


OP13_SQL = """
with d as (select row_number() over () as nr, doc_id, text from documents),
w as (select nr, doc_id, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')),
                                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from d),
n as (select nr, count(*) as n from w group by nr),
s as (select count(*) as nn, sum(n)::bigint as l from n),
f as (select nr, doc_id, t, count(*) as tf from w group by nr, doc_id, t),
v as (select t, floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1)))::bigint as w from f, s group by t, nn),
q as (select distinct item_id, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')),
                                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from benchmark),
h as (select item_id, nr, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // l))))::bigint as score
      from q join f using (t) join v using (t) join n using (nr), s group by item_id, nr, doc_id),
r as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from h where score > 0)
select item_id, rank::int as rank, doc_id, score from r where rank <= 50
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_source_mix": op5_source_mix,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_toxicity": op7_toxicity,
    "op8_packing": op8_packing,
    "op9_html_extraction": op9_html_extraction,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_run_length_index": op12_run_length_index,
    "op13_lexical_search": op13_lexical_search,
}
SQL = {"op1_url_filters": OP1_SQL, "op10_exact_dedup": OP10_SQL, "op11_source_divergence": OP11_SQL,
       "op12_run_length_index": OP12_SQL,
       "op13_lexical_search": OP13_SQL}
