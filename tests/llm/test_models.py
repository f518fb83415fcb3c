"""Source mix, language model, toxicity and packing against brute force, round trips and held-out rows."""

import math
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from helpers import frame, hard_texts, lower, prose, with_clash, with_odd_rows, words
from pyspark.sql import functions as F

from quire.llm import mixing, ngram_lm, packing, toxicity


def fill(sizes, weights, total, cap):
    """Targets by resharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    held = {}
    while True:
        free = [s for s in names if s not in held]
        left = total - sum(held.values())
        over = [s for s in free if left * w[s] / sum(w[x] for x in free) > cap * sizes[s]]
        if not over:
            return {s: held.get(s, left * w[s] / sum(w[x] for x in free) if s in free else 0) for s in names}
        held |= {s: cap * sizes[s] for s in over}


def test_source_mix(spark):
    r = random.Random(1)
    sources = [None, "é", "B", "a", "hot"]
    rows = [(i, prose(i, r.randrange(1, 60)), sources[min(4, r.randrange(9))]) for i in range(1500)] + [(2000, None, "zero"), (2001, "x y z", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix_sources(df, [3.0, 1.0, 2.0], 1.5, 2).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for x in out:
        sizes[x.source] += x.size
        taken[x.source] += x.taken
        target[x.source] = x.target
        assert x.taken == x.copies * x.size and x.copies in (0, 1, 2)
    assert len(out) == len(rows) and {x.doc_id: x.size for x in out} == {i: len(words(t)) for i, t, _ in rows}
    want = fill(sizes, [3.0, 1.0, 2.0], 1.5 * sum(sizes.values()), 2)
    for s, t in want.items():
        assert target[s] == pytest.approx(t)
        assert abs(taken[s] - t) <= 60
    again = mixing.mix_sources(df.repartition(7), [3.0, 1.0, 2.0], 1.5, 2).collect()
    assert sorted((x.doc_id, x.taken) for x in out) == sorted((x.doc_id, x.taken) for x in again)


def test_source_mix_of_odd_rows(spark):
    df = with_odd_rows(with_clash(frame(spark, hard_texts())))
    out = mixing.mix_sources(df, [3.0, 1.0], 1.5, 2, carry=df.columns)
    assert out.count() == df.count() and out.select("row.*").columns == df.columns
    assert mixing.mix_sources(df.where("false"), [1.0]).collect() == []
    empty = mixing.mix_sources(df.where("doc_id is null"), [1.0]).collect()
    assert [(x.size, x.taken, x.target) for x in empty] == [(0, 0, 0.0)]


def test_inclusion_rates(spark):
    """Expected words are what is left of a source, however large one document is."""
    sizes = {"a": [5000, 900, *[10 + i for i in range(60)]], "b": [7] * 30, None: [4000, 3000, 2000, 3, 2, 1], "c": [0, 0]}
    rows = [(s, n, float(n)) for s, v in sizes.items() for n in v]
    base = spark.createDataFrame(rows, "source string, size long, weight double")
    left = {"a": 6500.0, "b": 100.0, None: 6000.0, "c": 0.0}
    sums = {s: sum(n * n for n in v) for s, v in sizes.items()}
    plan = spark.createDataFrame([(s, left[s], left[s] / sums[s] if sums[s] else 0.0, float(max(v))) for s, v in sizes.items()],
                                 "source string, left double, rate double, top double")
    out = {x.source: x for x in mixing.inclusion_rates(base, plan).collect()}
    assert set(out) == set(sizes)
    for s, v in sizes.items():
        certain = set()  # brute force: the excess is handed on again and again
        while True:
            rest = [(i, n) for i, n in enumerate(v) if i not in certain]
            rate = (left[s] - sum(v[i] for i in certain)) / (sum(n * n for _, n in rest) or 1)
            more = {i for i, n in rest if rate * n > 1}
            if not more:
                break
            certain |= more
        got = [min(1.0, out[s].rate * n) for n in v]
        assert got == pytest.approx([1.0 if i in certain else rate * n for i, n in enumerate(v)])
        assert sum(n * p for n, p in zip(v, got, strict=True)) == pytest.approx(left[s])


def kneser_ney(train, order):
    """p(word | context) of an interpolated modified Kneser-Ney model, from dictionaries."""
    grams = Counter()
    for toks in train:
        padded = ["<s>"] * order + toks
        for n in range(1, order + 2):
            grams.update(tuple(padded[i - n + 1: i + 1]) for i in range(order, len(padded)))
    tables = {}
    for n in range(1, order + 1):
        if n == order:
            tables[n] = {g: c for g, c in grams.items() if len(g) == n}
        else:
            tables[n] = Counter(g[1:] for g in grams if len(g) == n + 1)
    vocabulary = len({g for g in grams if len(g) == 1})
    cuts = {n: ngram_lm.discounts(*[sum(c == k for c in t.values()) for k in (1, 2, 3, 4)]) for n, t in tables.items()}
    followers = {n: defaultdict(list) for n in tables}
    for n, t in tables.items():
        for g, c in t.items():
            followers[n][g[:-1]].append(c)

    def p(gram):
        n = len(gram)
        below = 1 / (vocabulary + 1) if n == 1 else p(gram[1:])
        seen = followers[n].get(gram[:-1])
        if not seen:
            return below
        c = tables[n].get(gram, 0)
        cut = (0, *cuts[n])[min(c, 3)]
        return (c - cut) / sum(seen) + sum(cuts[n][min(x, 3) - 1] for x in seen) / sum(seen) * below

    return p


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_language_model(spark, order):
    texts = [prose(i, 40, 25) for i in range(60)] + ["", None, "UPPER w1 Unseen", "w1", "often " * 700, "w1 often"]
    df = frame(spark, texts)
    model = ngram_lm.train(df.where("doc_id % 5 > 0").select("text"), order)
    tokens = [[*words(lower(t or "")), "</s>"] for t in texts]
    train = [t for i, t in enumerate(tokens) if i % 5 > 0]
    counts = Counter(w for t in train for w in t)
    n, v = sum(counts.values()), len(counts)
    p = kneser_ney(train, order)
    for x in ngram_lm.score(df, model, {"doc_id": F.col("doc_id")}).collect():
        toks = tokens[x.doc_id]
        padded = ["<s>"] * order + toks
        own = sum(math.log10(p(tuple(padded[i - order + 1: i + 1]))) for i in range(order, len(padded)))
        assert (x.n_tokens, x.n_known, x.train_tokens) == (len(toks), sum(counts[w] > 0 for w in toks), n)
        assert x.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in toks))
        assert x.score == pytest.approx(own, rel=1e-4), x.doc_id


def test_grams_of_ranks():
    parts, bounds = [], [0]
    for text in [prose(i, 30, 9) for i in range(5)] + ["", "w1"]:
        parts += [int(w[1:]) if w[1:].isdigit() else 99 for w in text.split()] + [0]
        bounds.append(len(parts))
    ranks = np.array([*parts, 1], np.int64)
    narrow, counts = ngram_lm._grams(ranks, np.array(bounds), 3)
    plain = Counter()
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        padded = [1, 1, *parts[a:b]]
        plain.update((padded[i + 1], padded[i + 2], padded[i]) for i in range(b - a))
    assert dict(zip(zip(*[c.tolist() for c in narrow], strict=True), counts.tolist(), strict=True)) == plain
    assert sorted(plain) == list(zip(*[c.tolist() for c in narrow], strict=True))
    wide, same = ngram_lm._grams(ranks << 40, np.array(bounds), 3)  # too wide for one number: sorted by columns
    assert [c.tolist() for c in wide] == [(c << 40).tolist() for c in narrow] and same.tolist() == counts.tolist()


@pytest.mark.parametrize("n", [0, 1, 7, 8, 100, 5000])
def test_keys_of_model_files(tmp_path, n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64))
    counts = np.arange(len(keys)) % 400
    ngram_lm._put_keys(str(tmp_path), "t", keys)
    ngram_lm._put_counts(str(tmp_path), "t", counts)
    files = ngram_lm.HashFiles(str(tmp_path), 2)
    at = ngram_lm._find(files, "t", keys)
    assert at.tolist() == list(range(len(keys))) and ngram_lm._counts(files, "t", at).tolist() == counts.tolist()
    other = np.random.default_rng(n + 1).integers(0, 2**64, 1000, dtype=np.uint64)
    assert (ngram_lm._find(files, "t", other) == -1).all()
    assert ngram_lm._counts(files, "absent", ngram_lm._find(files, "absent", other)).sum() == 0


def test_language_model_of_odd_rows(spark):
    df = with_odd_rows(with_clash(frame(spark, hard_texts())))
    model = ngram_lm.train(df.select("text"))
    out = ngram_lm.score(df, model, {"doc_id": F.col("doc_id")}).collect()
    assert len(out) == df.count() and all(math.isfinite(x.score) for x in out)
    nothing = ngram_lm.train(df.where("false").select("text"))
    assert {x.train_tokens for x in ngram_lm.score(df, nothing, {"doc_id": F.col("doc_id")}).collect()} == {0}
    assert ngram_lm.score(df.where("false"), model, {"doc_id": F.col("doc_id")}).collect() == []


def insult(seed, n):
    r = random.Random(seed)
    w = prose(seed, n).split(" ")
    for _ in range(3):
        w[r.randrange(n)] = r.choice(["fool", "Dolt!", "grubxa", "grubxe", "grubxi", "grubxon", "grubxul"])
    return " ".join(w)


def test_toxicity(spark):
    texts = [insult(i, 60) if i % 4 == 0 else prose(i, 60) for i in range(1600)]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(1600)], "doc_id long, quality int, toxic int")
    scorer = toxicity.fit_toxicity(docs, labels, "doc_id % 5 != 0", trees=5)
    out = {x.doc_id: x for x in scorer.score(docs).select("row.doc_id", "score", "predicted").collect()}
    held = [i for i in range(0, 1600, 5)]
    right = sum(out[i].predicted == int(i % 4 == 0) for i in held) / len(held)
    assert right > 0.97 and all(0 <= x.score <= 1 for x in out.values())


def test_toxicity_of_odd_rows(spark):
    df = with_odd_rows(with_clash(frame(spark, hard_texts())))
    labels = spark.createDataFrame([(i, i % 2) for i in range(36)] + [(None, 1), (5, None), (999, 1), (1, 1)], "doc_id long, toxic int")
    scorer = toxicity.fit_toxicity(df, labels, "true", trees=2)
    out = scorer.score(df)
    assert out.count() == df.count() and out.select("row.*").columns == df.columns
    none = toxicity.fit_toxicity(df, labels.where("false"), "true")
    assert {x.score for x in none.score(df).collect()} == {0.0}
    assert scorer.score(df.where("false")).collect() == []


def place(totals, quantum):
    """The packed stream, quantum by quantum, by its definition."""
    due = sorted((Fraction(k + 1, n), s, k) for s, n in enumerate(totals) if n for k in range(-(-n // quantum)))
    at, out = 0, {}
    for _, s, k in due:
        out[s, k] = at
        at += min(quantum, totals[s] - k * quantum)
    return out


def test_quanta_are_placed_in_order_of_deficit():
    for totals in ([1000, 10, 333, 0, 333], [1], [64, 64, 64], [7, 100_000]):
        want = place(totals, 64)
        spots = {}
        for s, n in enumerate(totals):
            if n:
                at = np.arange(-(-n // 64))
                for k, spot in zip(at.tolist(), packing.places(at, s, totals, 64).tolist(), strict=True):
                    spots[s, k] = spot
        end = 0
        for (s, k), spot in sorted(spots.items(), key=lambda x: x[1]):
            assert spot == end
            end += min(64, totals[s] - k * 64)
        assert end == sum(totals)
        assert spots == want
    huge = packing.places(np.arange(3), 0, [10**19, 10**19], 64)  # beyond 64 bits
    assert huge.tolist() == [0, 128, 256]


def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = hard_texts()
    sources = [None if i % 7 == 0 else f"s{i % 3}" for i in range(len(texts))]
    out = packing.pack(with_clash(frame(spark, texts, sources)), length=128, quantum=32).collect()
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in enumerate(texts)}
    at = defaultdict(int)
    for x in sorted(out, key=lambda x: (x.doc_id, x.start)):
        assert x.start == at[x.doc_id] and x.doc_tokens == len(ids[x.doc_id])
        assert x.ids_crc32 == zlib.crc32(ids[x.doc_id][x.start: x.start + x.length].tobytes())
        at[x.doc_id] += x.length
    assert at == {i: len(v) for i, v in ids.items()}
    end = 0
    for x in sorted(out, key=lambda x: (x.sequence_id, x.offset)):
        assert x.sequence_id * 128 + x.offset == end and x.offset + x.length <= 128
        end += x.length
    total = sum(map(len, ids.values()))
    share = Counter()
    for i, v in ids.items():
        share[sources[i]] += len(v)
    done = Counter()
    for x in sorted(out, key=lambda x: (x.sequence_id, x.offset)):
        done[x.source] += x.length
        upto = sum(done.values())
        assert all(-2 * 32 <= done[s] - upto * share[s] / total <= len(share) * 32 for s in share)


def test_packing_of_odd_rows(spark):
    df = with_odd_rows(with_clash(frame(spark, hard_texts())))
    out = packing.pack(df).collect()
    assert [(x.length, x.doc_tokens) for x in out if x.doc_id is None] == [(1, 1)]
    assert packing.pack(df.where("false")).collect() == []


def test_ids_of_long_white_space():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = packing._encoder("byte_bpe_50k.tiktoken")
    for text in (" " * 2_000_000, "a b" + "\n" * 2_000_000 + "x  y", "it's" + " \t" * 1_000_000 + "<|endoftext|> x",
                 "a" + " " * 2_000_000 + "b" + "\r\n" * 600_000 + " ", "\u3000" * 1_100_000 + "\x1c" + " " * 1_100_000 + "9"):
        assert packing.encoded(encoder, text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("totals, weights", [([1000, 10, 333, 1, 333], None), ([500, 700, 20], [1, 3, 2]), ([64], None),
                                             ([3000, 2900, 40], [10**18, 10**18, 5])])
def test_windows_of_a_mixture_are_prefixes_of_one_order(totals, weights):
    weights = weights or totals
    due = sorted(((2 * k + 1) * sum(weights) // (2 * w), s, k) for s, (n, w) in enumerate(zip(totals, weights)) for k in range(n))
    mixture = packing.Mixture(totals, weights, 64)
    for place in range(0, len(due) + 1, 7):
        got = mixture.first(np.array([place]))[0].tolist()
        assert got == [sum(s == x for _, x, _ in due[:place]) for s in range(len(totals))]
    some = due[::11]
    ranks = mixture.ranks(np.array([k for _, _, k in some]), np.array([s for _, s, _ in some]))
    assert ranks.tolist() == list(range(0, len(due), 11))


@pytest.mark.parametrize("shares", [None, {f"s{i}": 1 + i % 3 for i in range(20)}])
def test_packing_gives_every_window_its_mixture(spark, shares):
    texts = [prose(i, 40 + i % 17) for i in range(2000)]
    out = packing.pack(frame(spark, texts, [f"s{i % 20}" for i in range(2000)]), shares=shares).collect()
    held, totals, queue = defaultdict(Counter), Counter(), defaultdict(int)
    for x in sorted(out, key=lambda x: (x.sequence_id, x.offset)):
        assert x.sequence_id * 1024 + x.offset == sum(totals.values()) and x.offset + x.length <= 1024
        held[x.sequence_id][x.source] += x.length
        totals[x.source] += x.length
    for x in sorted(out, key=lambda x: (x.doc_id, x.start)):
        assert x.start == queue[x.doc_id]
        queue[x.doc_id] += x.length
    assert all(queue[x.doc_id] == x.doc_tokens for x in out) and len(queue) == 2000
    weights, left = shares or totals, dict(totals)
    for w in range(max(held)):  # all but the last
        if not shares or all(left[s] > held[w][s] for s in totals):  # no queue drains
            active = [s for s in totals if left[s]]
            for s in active:
                assert abs(held[w][s] - 1024 * weights[s] / sum(weights[x] for x in active)) <= 4, (w, s)
        for s in totals:
            left[s] -= held[w][s]
    with pytest.raises(ValueError, match="s19"):
        packing.pack(frame(spark, texts[:20], [f"s{i}" for i in range(20)]), shares={f"s{i}": 1 for i in range(19)})


def test_registered_model_has_the_default_order():
    import inspect

    from quire.llm import queries

    assert inspect.signature(ngram_lm.train).parameters["order"].default == queries.LM_ORDER
