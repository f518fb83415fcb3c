"""Exact copies, n-gram Jaccard groups and repeated passages against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from helpers import DOCS, edited, frame, hard_texts, lower, prose, with_clash, with_odd_rows, words

from quire.llm import passages, radix, set_join


def shingles(text, k):
    w = words(lower(text or ""))
    return {tuple(w[i: i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def brute_groups(texts, sim):
    sets = [shingles(t, sim.k) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i]) + len(sets[j])
            shared = len(sets[i] & sets[j])
            if shared and (sim.num + sim.den) * shared >= sim.num * both:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(texts))], [len(s) for s in sets]


def near_group(n, size, most, seed):
    base = prose(seed, size)
    r = random.Random(seed)
    return [edited(base, seed * 1000 + i, r.randrange(most + 1)) for i in range(n)]


@pytest.mark.parametrize("sim", [set_join.Similarity(3, 90, 100), set_join.Similarity()])
def test_groups_equal_brute_force(spark, sim):
    # groups larger than FREQUENT and LONG_LIST, with and without their base text; a passage that many share
    common = prose(99, 40)
    texts = hard_texts() + near_group(90, 150, 9, 7) + [t + " tail" for t in near_group(60, 60, 4, 8)]
    texts += [common + " " + prose(500 + i, 12) for i in range(80)] + near_group(25, 20, 2, 9)
    got = {r.doc_id: r for r in set_join.similar_groups(frame(spark, texts), sim).collect()}
    comps, sizes = brute_groups(texts, sim)
    assert len(got) == len(texts)
    assert [got[i].component_id for i in range(len(texts))] == comps
    assert [got[i].n_shingles for i in range(len(texts))] == sizes


def test_groups_of_odd_rows(spark):
    df = with_odd_rows(with_clash(frame(spark, hard_texts())))
    out = set_join.similar_groups(df, set_join.Similarity()).collect()
    assert len(out) == df.count()
    assert [r.component_id for r in out if r.doc_id is None] == [None]
    assert {r.component_id for r in out if r.doc_id == 6} == {6}
    kept = set_join.drop_similar(df, set_join.Similarity())
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 7 not in ids and 9 not in ids and ids.count(6) == 2 and {0, 1, 2, 3, 4} <= set(ids)


def test_empty_tables(spark):
    none = frame(spark, ["x"]).where("false")
    assert set_join.similar_groups(none, set_join.Similarity()).collect() == []
    assert set_join.drop_similar(none, set_join.Similarity()).collect() == []
    assert radix.exact_groups(none).collect() == []
    assert passages.repeated_passages(none).collect() == []


def test_exact_copies(spark):
    long = prose(3, 40_000, 9000)
    texts = hard_texts() + [long, long, long[:-1], long + "x", "", None] + ["hot"] * 50 + [long[:48], long[:48] + "y", long[:49]]
    got = {r.doc_id: r for r in radix.exact_groups(frame(spark, texts)).collect()}
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[t or ""].append(i)
    for text, ids in groups.items():
        for i in ids:
            r = got[i]
            assert (r.keep_id, r.group_size, r.kept) == (max(ids), len(ids), i == max(ids))
            assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert len(got) == len(texts)


def test_exact_copies_of_odd_rows(spark):
    df = with_odd_rows(with_clash(frame(spark, hard_texts())))
    out = radix.exact_groups(df, carry=df.columns)
    kept = out.where("kept").select("row.*")
    assert kept.columns == df.columns
    texts = [r.text or "" for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({t or "" for t in hard_texts()})
    only_null = radix.exact_groups(df.where("doc_id is null")).collect()
    assert [(r.keep_id, r.group_size, r.kept) for r in only_null] == [(None, 1, True)]
    twice = radix.exact_groups(df.where("doc_id = 6")).collect()
    assert sorted(r.kept for r in twice) == [False, True]


def brute_repeats(texts, n):
    """Per document the words in runs of ``n`` words that an earlier document has too."""
    first, need = {}, defaultdict(set)
    for i, t in enumerate(texts):
        w = words(t)
        runs = [tuple(w[j: j + n]) for j in range(len(w) - n + 1)]
        for j, run in enumerate(runs):
            if first.get(run, i) != i:
                need[i].update(range(j, j + n))
        for run in runs:
            first.setdefault(run, i)
    return need


def test_repeated_passages(spark):
    shared = [prose(s, n) for s, n in ((70, 50), (71, 55), (72, 80), (73, 200))]
    texts = [f"{prose(200 + i, 120)} {shared[i % 4]} {prose(300 + i, 90)}" for i in range(40)]
    texts += hard_texts() + [f"{prose(900, 100)} {edited(shared[3], 5, 3)} {prose(901, 30)}"]
    got = defaultdict(set)
    for r in passages.repeated_passages(frame(spark, texts)).collect():
        got[r.doc_id].update(range(r.start_word, r.end_word))
        a, b = words(texts[r.doc_id])[r.start_word: r.end_word], words(texts[r.source_doc_id])[r.source_start: r.source_end]
        x, y = ({tuple(w[j: j + 5]) for j in range(len(w) - 4)} for w in (a, b))
        assert r.source_doc_id < r.doc_id and len(a) >= 50 and len(x & y) >= 0.8 * len(x | y)
    for i, need in brute_repeats(texts, 50).items():
        assert need <= got[i], i
    assert len(texts) - 1 in got  # the edited passage
    clean = [prose(5000 + i, 150, 10**6) for i in range(20)]
    assert passages.repeated_passages(frame(spark, clean)).collect() == []


def test_repeated_passages_of_odd_rows(spark):
    df = with_odd_rows(with_clash(frame(spark, hard_texts())))
    out = passages.repeated_passages(df).collect()
    assert {(r.doc_id, r.source_doc_id) for r in out} >= {(7, 6), (15, 14)}
    assert spark.createDataFrame([], DOCS).count() == 0


def test_nearest_smaller_is_the_cartesian_tree():
    order, at = [5, 3, 8, 1, 9], [2, 4, 7, 9, 11]
    spans = passages.nearest_smaller(order, at, 0, 14)
    assert spans == [(0, 3), (0, 8), (5, 8), (0, 13), (10, 13)]


def test_window_minima_are_all_minima():
    import numpy as np

    values = np.array([random.Random(4).randrange(2**63) for _ in range(400)], np.uint64)
    doc = np.repeat([0, 1, 2], [150, 20, 230])
    at, order = passages.window_minima(values, doc, 30, 0)
    key = (values * passages._FUNCTIONS[0]).tolist()
    want = set()
    for start in range(len(key) - 29):
        if doc[start] == doc[start + 29]:
            want.add(min(range(start, start + 30), key=lambda i: key[i]))
    assert set(at.tolist()) == want and len(order) == len(at)


@pytest.mark.parametrize("n, second", [(60, 30), (100, 60), (60, 5), (200, 3)])
def test_passages_with_inner_repeats(n, second):
    p = passages.Passages()
    passage = prose(31, n, 10**6).split()
    passage[second: second + 5] = passage[:5]  # a five-word shingle stands twice
    a, b = prose(32, 40, 10**6).split() + passage, passage + prose(33, 40, 10**6).split()
    x, y = (np.array([hash(tuple(w[i: i + 5])) for i in range(len(w) - 4)]).astype(np.uint64) for w in (a, b))
    assert passages.aligned_spans(x, y, p) == [(40, 40 + n - 5, 0, n - 5)]


def test_passages_of_one_refrain():
    p = passages.Passages()
    verse = [prose(40 + i, 12, 10**6).split() for i in range(8)]
    song = [w for v in verse for w in [*v, *prose(39, 6, 10**6).split()]]  # the same line after every verse
    for a, b in ((song, song), (song[9:], song), (["la"] * 3000, ["la"] * 2000), (song, prose(50, 30, 10**6).split() + song[:70])):
        x, y = (np.array([hash(tuple(w[i: i + 5])) for i in range(len(w) - 4)]).astype(np.uint64) for w in (a, b))
        spans = passages.aligned_spans(x, y, p)
        long = min(len(x), 66 if b[:1] != song[:1] and len(b) == 100 else len(x))
        assert spans[0][0] == 0 and max(s[1] for s in spans) >= min(long, len(y)) - 1


def test_passages_behind_earlier_partial_copies(spark):
    """Exact passages of two later documents, parts of which stand in earlier ones, against brute force."""
    texts: list[str] = []
    for t in range(60):
        w = prose(6000 + t, 50 + t % 11, 10**6).split()
        parts = [w[:40]] if t % 3 == 0 else [w[:30], w[-30:]] if t % 3 == 1 else [w[:22], w[20:42], w[-22:]]
        for i, part in enumerate([*parts, w, w]):
            texts.append(" ".join([prose(7000 + 10 * t + i, 60, 10**6), *part, prose(9000 + 10 * t + i, 60, 10**6)]))
    texts.append(texts[-1] + " tail")
    got = defaultdict(set)
    for r in passages.repeated_passages(frame(spark, texts)).collect():
        got[r.doc_id].update(range(r.start_word, r.end_word))
        assert r.source_doc_id < r.doc_id
    need = brute_repeats(texts, 50)
    assert len(need) == 61 and all(v <= got[i] for i, v in need.items())


@pytest.mark.parametrize("bound", [set_join.SMALL_GRAPH, 60, 0])
def test_components(spark, monkeypatch, bound):
    r = random.Random(5)
    edges = [(i, i + 1) for i in range(-40, 0)] + [(100 + r.randrange(120), 100 + r.randrange(120)) for _ in range(70)] + [(7, 7), (3, 9), (9, 3)]
    least = {x: x for e in edges for x in e}
    for _ in least:
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    monkeypatch.setattr(set_join, "SMALL_GRAPH", bound)
    got = {x.key: x.comp for x in set_join.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: c for x, c in least.items() if any(a != b and x in (a, b) for a, b in edges)}
    assert set_join.connected(spark.createDataFrame([], "a long, b long")).collect() == []


def test_edited_passages_behind_third_documents(spark):
    """Two edited copies of a passage are linked although every shingle of it stands in earlier documents, none of which
    has enough of it."""
    texts, late = [], []
    for t in range(6):
        w = prose(20_000 + t, 90, 10**6).split()
        for i in range(0, 84, 12):
            texts.append(" ".join([prose(21_000 + 100 * t + i, 70, 10**6), *w[i: i + 18], prose(22_000 + 100 * t + i, 70, 10**6)]))
        late.append((w, t))
    for copy, place in ((0, 45), (1, 47)):  # no 50 words in a row are equal
        for w, t in late:
            some = [f"edit{copy}" if j == place else x for j, x in enumerate(w)]
            texts.append(" ".join([prose(23_000 + 10 * t + copy, 60, 10**6), *some, prose(24_000 + 10 * t + copy, 60, 10**6)]))
    links = defaultdict(set)
    for r in passages.repeated_passages(frame(spark, texts)).collect():
        links[r.doc_id].add(r.source_doc_id)
        assert r.source_doc_id < r.doc_id and r.end_word - r.start_word >= 50
    for i in range(6):
        assert len(texts) - 12 + i in links[len(texts) - 6 + i]
