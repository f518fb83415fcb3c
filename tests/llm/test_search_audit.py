"""Divergence audit, run-length index and stratified search against plain Python."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import DOCS, edited, frame, hard_texts, lower, prose, with_clash, with_odd_rows
from quire.llm import divergence, queries, run_index, strata_search

LETTERS = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
ALNUM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# ---------------------------------------------------------------- op11

def plain_divergence(rows, min_docs, top):
    rows = [(t or "", lang or "", src or "") for t, lang, src in rows]
    out = []
    for lang in {r[1] for r in rows}:
        df, count = {}, {}
        sources = {r[2] for r in rows if r[1] == lang}
        for t, la, src in rows:
            if la == lang:
                terms = LETTERS.findall(lower(t))
                for x in set(terms):
                    df[x] = df.get(x, 0) + 1
                for x in terms:
                    count[src, x] = count.get((src, x), 0) + 1
        kept = [t for t, n in df.items() if n >= min_docs]
        share = lambda n, total: 1 + 1_000_000_000 * (n + 2) // (total + 2 * len(kept))
        f = lambda p, q: (p - q) * (p - q) // (p + q)
        p = {s: {t: share(count.get((s, t), 0), sum(count.get((s, x), 0) for x in kept)) for t in kept} for s in sources}
        every = {t: sum(count.get((s, t), 0) for s in sources) for t in kept}
        q = {t: share(every[t], sum(every.values())) for t in kept}
        for s in sources:
            pair = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s)
            out += [(lang, s, "pair", o, -v, i) for i, (v, o) in enumerate(pair, 1)]
            term = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if (s, t) in count and p[s][t] > q[t])
            out += [(lang, s, "term", t.decode(), -v, i) for i, (v, t) in enumerate(term[:top], 1)]
    return sorted(out)


def test_divergence_against_plain(spark):
    r = random.Random(5)
    texts = [*hard_texts(), *[prose(s, 40, 60) for s in range(40)], "abcdefgh abcdefghi ABCDEFGH1abcdefgh", "abcdefghé É x" * 3]
    rows = [(i, t, r.choice(["en", "de", None, ""]), r.choice(["a", "b", "é", None]), 0) for i, t in enumerate(texts)]
    df = with_odd_rows(spark.createDataFrame(rows, DOCS))
    plain = [(x.text, x.lang, x.source) for x in df.collect()]
    for min_docs, top in ((2, 10), (4, 3), (1000, 10)):
        got = divergence.source_divergence(with_clash(df), min_docs, top)
        assert sorted(tuple(x) for x in got.collect()) == plain_divergence(plain, min_docs, top)
    assert divergence.source_divergence(df.limit(0)).count() == 0


def test_pointer_sort_of_long_and_equal_tokens():
    r = random.Random(3)
    tokens = ["".join(r.choice("ab") for _ in range(r.choice([1, 7, 8, 9, 15, 16, 17, 40]))) for _ in range(500)] * 2
    data = np.frombuffer(" ".join(tokens).encode(), np.uint8)
    end = np.cumsum([len(t) + 1 for t in tokens]) - 1
    start = end - [len(t) for t in tokens]
    order = np.arange(len(tokens))
    fresh = divergence.pointer_sort(data, start, end, order)
    ranked = sorted(range(len(tokens)), key=lambda i: (tokens[i], i))
    assert order.tolist() == ranked
    assert fresh.tolist() == [i == 0 or tokens[ranked[i]] != tokens[ranked[i - 1]] for i in range(len(tokens))]


@pytest.mark.parametrize(("n", "total", "terms"), [(0, 0, 1), (7, 7, 3), (10**12, 10**13, 10**8), (9 * 10**12, 9 * 10**12, 5)])
def test_share_is_exact(spark, n, total, terms):
    want = 1 + 1_000_000_000 * (n + 2) // (total + 2 * terms)
    row = spark.createDataFrame([(n, total, terms)], "n long, total long, terms long")
    assert row.select(divergence.share("n", "total", "terms")).first()[0] == want
    assert divergence.shares(np.array([n]), np.array([total]), terms)[0] == want


# ---------------------------------------------------------------- op12

def plain_repeats(rows, limit):
    """rows in order: (text); per row the covered bytes."""
    seen, out = set(), []
    for t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - limit + 1):
            s = data[i: i + limit]
            if s in seen:
                gone[i: i + limit] = b"\1" * limit
            else:
                seen.add(s)
        out.append((data, gone))
    return out


def repeat_texts():
    passage = prose(100, 40, 5000)
    texts = [prose(i, 60, 5000) for i in range(6)]
    texts += [texts[0], texts[1] + " " + passage, prose(50, 30, 5000) + " " + passage + " x", passage, edited(passage, 3, 1),
              "a" * 700, "ab" * 300, "b" + "a" * 350, "é" * 90, passage[:99], passage[:100], passage[1:], "", None, " ".join([passage] * 3)]
    texts += [prose(7, 300, 3), prose(8, 300, 3), *hard_texts()]
    return texts


@pytest.mark.parametrize("limit", [100, 40])
def test_repeats_against_plain(spark, monkeypatch, limit):
    monkeypatch.setattr(run_index, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(run_index, "BLOCK", 1 << 9)
    texts = repeat_texts()
    random.Random(limit).shuffle(texts)
    got = {r.doc_id: r for r in run_index.remove_repeats(with_clash(frame(spark, texts).repartition(3)), limit).collect()}
    for i, (data, gone) in enumerate(plain_repeats(texts, limit)):
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        assert [(s.start, s.end) for s in got[i].spans] == spans, i
        assert got[i].n_bytes == len(data)
        assert bytes(got[i].kept) == bytes(b for b, g in zip(data, gone, strict=True) if not g)
    assert len(got) == len(texts)


def test_repeats_of_ids_and_empty_table(spark):
    df = frame(spark, [prose(1, 50), prose(2, 50)])
    odd = df.unionByName(df).unionByName(spark.createDataFrame([(None,) * 5, (None, prose(2, 50), None, None, None)], DOCS))
    got = sorted((-1 if r.doc_id is None else r.doc_id, len(r.kept)) for r in run_index.remove_repeats(odd).collect())
    size = [len(prose(1, 50)), len(prose(2, 50))]
    assert got == sorted([(-1, 0), (-1, size[1]), (0, size[0]), (0, 0), (1, 0), (1, 0)])
    assert run_index.remove_repeats(df.limit(0)).count() == 0


def test_matching_statistics_of_foreign_patterns():
    r = random.Random(9)
    for alphabet, limit in ((b"ab", 6), (b"abcdefgh", 3), (bytes(range(256)), 2)):
        texts = [bytes(r.choice(alphabet) for _ in range(r.randrange(0, 60))) for _ in range(12)]
        texts += [texts[0], texts[1][3:], b""]
        patterns = [*[bytes(r.choice(alphabet) for _ in range(r.randrange(0, 80))) for _ in range(10)], texts[2] + texts[3], b"zz"]
        pack = lambda xs: (np.frombuffer(b"".join(xs), np.uint8), np.append(0, np.cumsum([len(x) for x in xs])))
        index = run_index.RunIndex(*pack(texts), limit)
        length, first = index.stream(*pack(patterns), limit, lengths=True)
        assert index.stream(*pack(patterns), limit)[1].tolist() == first.tolist()
        at = 0
        for p in patterns:
            for i in range(len(p)):
                most = max(n for n in range(len(p) - i + 1) if any(p[i: i + n] in t for t in texts))
                assert length[at] == most
                want = -1
                if most >= limit:
                    k = next(k for k, t in enumerate(texts) if p[i: i + limit] in t)
                    want = int(index.bounds[k]) + texts[k].find(p[i: i + limit])
                assert first[at] == want
                at += 1


def test_op12_digest(spark, tmp_path):
    texts = repeat_texts()
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op12_run_length_index(spark, str(tmp_path)).collect()}
    for i, (data, gone) in enumerate(plain_repeats(texts, 100)):
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (
            len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())


# ---------------------------------------------------------------- op13

def plain_search(docs, items, k):
    docs = [(-(1 << 63) if i is None else i, ALNUM.findall(lower(t or ""))) for i, t in docs]
    docs = [d for d in docs if d[1]]
    total, df = sum(len(t) for _, t in docs), {}
    for _, terms in docs:
        for t in set(terms):
            df[t] = df.get(t, 0) + 1
    w = {t: math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(ALNUM.findall(lower(t or "")))
    for item, terms in asked.items():
        found = []
        for i, words in docs:
            m = 50 + 50 * len(words) * len(docs) // total
            s = sum(w[t] * (1_000_000_000 * words.count(t) // (1000 * words.count(t) + 20 * m)) for t in terms if t in words)
            if s > 0:
                found.append((-s, i))
        out += [(item, n, i if i != -(1 << 63) else None, -s) for n, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=lambda x: x[:2])


@pytest.mark.parametrize(("k", "block", "shard"), [(50, 200_000, 4 << 20), (3, 10, 2000)])
def test_search_against_plain(spark, monkeypatch, k, block, shard):
    monkeypatch.setattr(strata_search, "SHARD_BYTES", shard)
    texts = [*hard_texts(), *[prose(s, 5 + s % 90, 60) for s in range(120)]]
    texts += [texts[40]] * 4
    docs = with_odd_rows(frame(spark, texts))
    items = [(0, prose(200, 12, 60)), (1, texts[41]), (2, ""), (3, None), (None, "w1"), (4, "W1 w2, w2"), (4, "w3"), (5, "nowhere"),
             (6, " ".join(f"w{i}" for i in range(400)))]
    asked = spark.createDataFrame(items, "item_id long, text string")
    index = strata_search.build_index(with_clash(docs))
    got = strata_search.search(index, with_clash(asked), k, block_terms=block)
    assert [tuple(r) for r in got.orderBy("item_id", "rank").collect()] == plain_search(
        [(r.doc_id, r.text) for r in docs.collect()], items, k)


def test_search_of_empty_tables(spark):
    docs, asked = frame(spark, ["a b"]), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert strata_search.search(strata_search.build_index(docs.limit(0)), asked).count() == 0
    assert strata_search.search(strata_search.build_index(docs), asked.limit(0)).count() == 0
