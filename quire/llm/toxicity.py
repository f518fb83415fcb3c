"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

The training rows are split in three by a hash of their ids: the lexicon is learned on the first part, the trees
on the second, the calibration on the third, so no step sees rows that an earlier one has fitted.  The lexicon holds
words, and beginnings of words, that are far more frequent in toxic than in other texts.  Trees and calibration
are fitted by Spark ML on the small table of the labelled rows' features; scoring is one pass in which rows stay
where they are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import words as W
from quire.llm.store import written

MAX_LABELLED = 200_000  # labelled rows that are used for fitting, chosen by a hash of their ids
MAX_LEXICON = 8192
PREFIX_BYTES = 5
NEAR_WORDS = 4
WINDOW = 25
# fixed values: second-person pronouns of the languages in use
SECOND_PERSON = ["you", "your", "yours", "yourself", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "te", "toi",
                 "vous", "votre", "ton", "ta", "usted", "ustedes", "ti", "tus"]
FEATURES = ["log_words", "word_hits", "prefix_hits", "word_density", "prefix_density", "weight_density", "max_weight",
            "top_window", "second_person", "near_second_person", "capitals", "shouted", "exclaims", "punctuation",
            "obfuscated", "odd_symbols"]

_APART = np.ones(256, bool)  # bytes between the tokens of this module: all but letters, digits and UTF-8 bytes
_APART[48:58] = _APART[65:91] = _APART[97:123] = False
_APART[128:] = False
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_ALPHA = ~_APART.copy()
_ALPHA[48:58] = False
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MASK = np.zeros(256, bool)
_MASK[list(b"@$*#!|0135")] = True  # fixed values: characters put in place of letters
_MARK = np.zeros(256, bool)
_MARK[list(b"!?")] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[33:48] = _PUNCT[58:65] = _PUNCT[91:97] = _PUNCT[123:127] = True
_PREFIX = np.uint64(0x9E3779B97F4A7C15)


class _Tokens(W.Words):
    """Runs of letters and digits."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        plain = np.where(_APART[data], np.uint8(32), np.maximum(data, 33).astype(np.uint8))
        super().__init__(plain, offsets)
        self.data = data


def _keys(t: _Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Lexicon keys of each token: of its lower-cased text, and of its beginning (0 where it is not longer)."""
    word = t.hashes(lower=True)
    head = W.mix(t.hashes(lower=True, prefix=PREFIX_BYTES) ^ _PREFIX)
    return word, np.where(t.end - t.start > PREFIX_BYTES, head, np.uint64(0))


def word_key(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(_keys(_Tokens(data, np.array([0, len(data)])))[0][0])


def _spots(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _most(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bounds) - 1)
    has = bounds[1:] > bounds[:-1]
    if has.any():
        out[has] = np.maximum.reduceat(values, bounds[:-1][has])
    return out


def dense_features(data: np.ndarray, offsets: np.ndarray, lexicon: np.ndarray, weights: np.ndarray,
                   persons: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per text; ``lexicon`` and ``persons`` are sorted keys."""
    t = _Tokens(data, offsets)
    word, head = _keys(t)

    def weigh(keys: np.ndarray) -> np.ndarray:
        if not len(lexicon):
            return np.zeros(len(keys))
        i = np.minimum(np.searchsorted(lexicon, keys), len(lexicon) - 1)
        return np.where(lexicon[i] == keys, weights[i], 0.0)

    ww, wh = weigh(word), weigh(head)
    best = np.maximum(ww, wh)
    hit = best > 0
    n = np.maximum(t.count, 1)
    size = np.maximum(np.diff(offsets), 1)
    you = np.isin(word, persons)
    near = np.zeros(len(word), bool)
    for step in range(1, NEAR_WORDS + 1):  # a hit with a pronoun close by, in the same text
        same = t.doc[step:] == t.doc[:-step]
        near[step:] |= hit[step:] & you[:-step] & same
        near[:-step] |= hit[:-step] & you[step:] & same
    run = np.concatenate([[0.0], np.cumsum(best)])
    stop = np.minimum(np.arange(len(word)) + WINDOW, t.bounds[1:][t.doc]) if len(word) else np.zeros(0, int)
    window = run[stop] - run[:-1]
    upper = _UPPER[data]
    ups = np.concatenate([[0], np.cumsum(upper)])
    shout = (ups[t.end] - ups[t.start] == t.end - t.start) & (t.end - t.start > 2)
    masked = np.zeros(len(data), bool)  # a masking character or digit between two letters of one text
    if len(data) > 2:
        inner = _MASK[data[1:-1]] & _ALPHA[data[:-2]] & _ALPHA[data[2:]]
        masked[1:-1] = inner
        cuts = offsets[1:-1]
        masked[cuts[cuts < len(data)]] = False
        masked[cuts[cuts > 0] - 1] = False
    alpha = np.maximum(_spots(_ALPHA[data], offsets), 1)
    sums = {
        "log_words": np.log1p(t.count), "word_hits": np.log1p(_spots(ww > 0, t.bounds)),
        "prefix_hits": np.log1p(_spots(wh > 0, t.bounds)), "word_density": 100 * _spots(ww > 0, t.bounds) / n,
        "prefix_density": 100 * _spots(wh > 0, t.bounds) / n, "weight_density": 100 * _spots(best, t.bounds) / n,
        "max_weight": _most(best, t.bounds), "top_window": _most(window, t.bounds),
        "second_person": 100 * _spots(you, t.bounds) / n, "near_second_person": 100 * _spots(near, t.bounds) / n,
        "capitals": _spots(upper, offsets) / alpha, "shouted": _spots(shout, t.bounds) / n,
        "exclaims": 100 * _spots(_MARK[data], offsets) / size, "punctuation": _spots(_PUNCT[data], offsets) / size,
        "obfuscated": 100 * _spots(masked, offsets) / n, "odd_symbols": 100 * _spots(_MASK[data] & ~_DIGIT[data], offsets) / size}
    return np.stack([sums[f] for f in FEATURES], 1)


def learn_lexicon(labelled: DataFrame, min_toxic: int = 5, min_ratio: float = 6.0) -> list[tuple[int, float]]:
    """(key, weight) of at most ``MAX_LEXICON`` words and beginnings, from (text, toxic).

    Counted are texts, not occurrences, over all rows; the weight is the log of the ratio of a key's share of the
    toxic texts to its share of the others.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.asarray(batch.column(1).to_numpy(zero_copy_only=False)).astype(np.int64)
            for a, b, data, offsets in W.chunks(batch.column(0)):
                t = _Tokens(data, offsets)
                word, head = _keys(t)
                key, doc = np.concatenate([word, head]), np.concatenate([t.doc, t.doc])
                key, doc = key[key != 0], doc[key != 0]
                order = np.lexsort((doc, key))
                key, doc = key[order], doc[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
                key, label = key[new], toxic[a:b][doc[new]]
                if not len(key):
                    continue
                at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                bad, seen = np.add.reduceat(label, at), np.diff(np.append(at, len(key)))
                yield pa.RecordBatch.from_arrays([pa.array(key[at].view(np.int64)), pa.array(bad), pa.array(seen - bad)],
                                                 ["key", "bad", "good"])

    total = labelled.agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    bad_n, good_n = total.t or 0, (total.n or 0) - (total.t or 0)
    counts = labelled.select("text", F.col("toxic").cast("long")).mapInArrow(lambda it: W.released(count(it)), "key long, bad long, good long")
    ratio = (F.col("bad") + 0.5) / (bad_n + 1.0) / ((F.col("good") + 0.5) / (good_n + 1.0))
    top = (counts.groupBy("key").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).where(f"bad >= {min_toxic}")
           .withColumn("ratio", ratio).where(f"ratio >= {min_ratio}")
           .orderBy(F.col("bad") * F.log("ratio"), "key", ascending=False).limit(MAX_LEXICON).select("key", "ratio"))
    return [(int(np.int64(r.key).view(np.uint64)), math.log(r.ratio)) for r in top.collect()]


@dataclass
class Scorer:
    """A fitted lexicon, trees and calibration curve; without trees the score is ``share`` for every text."""

    keys: np.ndarray
    weights: np.ndarray
    trees: GBTClassificationModel | None
    curve: IsotonicRegressionModel | None
    share: float

    def features(self, docs: DataFrame, text: str) -> DataFrame:
        """``docs`` as a struct ``row`` with an array ``x`` of its text's features."""
        keys, weights = self.keys, self.weights
        persons = np.array(sorted(word_key(w) for w in SECOND_PERSON), np.uint64)
        packed = docs.select(F.struct("*").alias("row"), F.col(f"`{text}`").alias("text"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a, b, data, offsets in W.chunks(batch.column(1)):
                    x = dense_features(data, offsets, keys, weights, persons)
                    ends = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(ends, pa.array(x.reshape(-1)))], ["row", "x"])

        schema = T.StructType([packed.schema["row"], T.StructField("x", T.ArrayType(T.DoubleType()))])
        return packed.mapInArrow(lambda it: W.released(run(it)), schema)

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """(row, score, predicted) per row of ``docs``; ``row`` is a struct of all its columns."""
        out = self.features(docs, text_col)
        if self.trees is None:
            out = out.withColumn("score", F.lit(self.share))
        else:
            out = self.curve.transform(_margin(self.trees, out)).withColumn("score", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)))
        return out.select("row", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _margin(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return trees.transform(rows.withColumn("features", array_to_vector("x"))).withColumn("margin", vector_to_array(F.col("rawPrediction"))[1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, train: str, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", trees: int = 20, depth: int = 4, max_labelled: int = MAX_LABELLED) -> Scorer:
    """A scorer learned from the labelled rows whose id meets the condition ``train`` (over ``doc_id``).

    At most ``max_labelled`` labels are used (the smallest hashes of their ids), a bounded sample for
    fitting.  Null and empty texts have features of zero.  Rows with a null id or label are not learned from; an id
    that is labelled twice counts as toxic if it is so once.  Without both labels in the parts for trees and
    calibration the score is the share of label 1 (0 without labels).
    """
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    known = (labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
             .where("doc_id is not null and toxic in (0, 1)").where(train)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .withColumn("h", F.xxhash64("doc_id", F.lit(11))).orderBy("h", "doc_id").limit(max_labelled)
             .withColumn("part", F.pmod("h", F.lit(5)).cast("int")))
    known = written(known.select("doc_id", "toxic", "part"), "tox-labels")
    small = F.broadcast(known)  # at most max_labelled rows of two numbers
    lexicon = sorted(learn_lexicon(slim.join(small.where("part < 2"), "doc_id").select("text", "toxic")))
    share = float(known.agg(F.avg("toxic")).first()[0] or 0.0)
    scorer = Scorer(np.array([k for k, _ in lexicon], np.uint64), np.array([w for _, w in lexicon], np.float64), None, None, share)
    fit = written(scorer.features(slim.join(small.where("part >= 2"), "doc_id"), "text").select(
        "x", F.col("row.toxic").cast("double").alias("toxic"), (F.col("row.part") < 4).alias("grow")), "tox-features")
    seen = {(r.grow, r.toxic) for r in fit.select("grow", "toxic").distinct().collect()}
    if len(seen) == 4:
        grow = fit.where("grow").select(array_to_vector("x").alias("features"), "toxic")
        scorer.trees = GBTClassifier(labelCol="toxic", maxIter=trees, maxDepth=depth, stepSize=0.2, checkpointInterval=-1,
                                     seed=5, minInstancesPerNode=5).fit(grow.coalesce(4))
        held = _margin(scorer.trees, fit.where("not grow")).select("margin", "toxic")
        scorer.curve = IsotonicRegression(labelCol="toxic", featuresCol="margin", predictionCol="score").fit(held)
    return scorer
