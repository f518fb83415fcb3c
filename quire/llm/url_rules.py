"""URL rules by a sort-merge range join.

A host is written with its labels reversed and a closing dot (``www.example.com`` -> ``com.example.www.``), so
that a rule's host covers the keys of one interval: the host itself and all its subdomains.  Urls are range
partitioned by (key, path, id), which also splits a host or a url that holds a large part of all rows.  Rules go
to every partition that their interval meets, and one sweep over the sorted rows of a partition keeps a stack of
the nested rule hosts that are open at the current key.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.store import partitions, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end; empty if there is none."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """One row (id, host, path, rule, verdict) per row of ``pages``.

    ``rules`` has host, path and verdict (allow or block).  A rule fits its host and all subdomains when the url's
    path starts with the rule's path; the rule with the longest text (host + path) wins, the longer host among
    equals, and block wins between two verdicts for one rule.  Rules with a null field fit nothing.  A url without
    ``://`` and a null url have an empty host and path and fit no rule; repeated rows stay repeated; other columns
    are ignored; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    n = partitions(spark)
    url = F.col(f"`{url_col}`")
    keyed = pages.select(F.col(f"`{id_col}`").alias("id"), url_host(url).alias("host"), url_path(url).alias("path"))
    keyed = keyed.withColumn("key", host_key(F.col("host")))
    urls = written(keyed.repartitionByRange(n, "key", "path", "id").withColumn("part", F.spark_partition_id()), "urls")
    # one row per partition: bounded by the number of partitions
    spans = sorted(urls.groupBy("part").agg(F.min("key").alias("a"), F.max("key").alias("b")).collect())
    parts, first, last = [s.part for s in spans], [s.a for s in spans], [s.b for s in spans]

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            low = [bisect_left(last, k) for k in b["key"]]
            high = [bisect_right(first, k[:-1] + "/") for k in b["key"]]
            b["part"] = [parts[x:y] for x, y in zip(low, high, strict=True)]
            b = b.explode("part").dropna(subset=["part"])
            yield b.astype({"part": "int32"})

    clean = (rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
             .where("host != '' and path is not null and verdict is not null")
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))
    clean = clean.select("host", "path", "verdict", host_key(F.col("host")).alias("key"))
    spread_rules = clean.mapInPandas(spread, "host string, path string, verdict string, key string, part int")
    id_type = dict(urls.dtypes)["id"]
    rows = urls.select("part", "key", F.lit(1).alias("kind"), "host", "path", "id", F.lit(None).cast("string").alias("verdict")
                       ).unionByName(spread_rules.withColumns({"kind": F.lit(0), "id": F.lit(None).cast(id_type)}))
    rows = rows.repartition(n, "part").sortWithinPartitions("part", "key", "kind", "path")
    out = rows.mapInPandas(lambda it: _sweep(it, default), f"id {id_type}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("id", id_col)


def _sweep(batches: Iterator[pd.DataFrame], default: str) -> Iterator[pd.DataFrame]:
    """Sorted rules and urls of whole partitions; a rule sorts before the urls of its key."""
    stack: list[tuple[str, str, str, dict[str, str], list[int]]] = []  # key, end, host, verdict by path, path lengths
    part = None
    for b in batches:
        kept, rules, verdicts = [], [], []
        for i, (p, key, kind, host, path, verdict) in enumerate(
                zip(b["part"], b["key"], b["kind"], b["host"], b["path"], b["verdict"], strict=True)):
            if p != part:
                part, stack = p, []
            while stack and key >= stack[-1][1]:
                stack.pop()
            if kind == 0:
                if not stack or stack[-1][0] != key:
                    stack.append((key, key[:-1] + "/", host, {}, []))
                stack[-1][3][path] = verdict
                if len(path) not in stack[-1][4]:
                    stack[-1][4].append(len(path))
                    stack[-1][4].sort(reverse=True)
                continue
            best = None
            for _, _, rule_host, by_path, lengths in reversed(stack):
                fit = next((path[:n] for n in lengths if path[:n] in by_path), None)
                if fit is not None and (best is None or len(rule_host) + len(fit) > len(best[0])):
                    best = rule_host + fit, by_path[fit]
            kept.append(i)
            rules.append(best[0] if best else None)
            verdicts.append(best[1] if best else default)
        out = b.iloc[kept][["id", "host", "path"]].copy()
        out["rule"], out["verdict"] = pd.Series(rules, out.index, object), pd.Series(verdicts, out.index, object)
        yield out
