"""Quality classifier: Bradley-Terry ranking of documents.

A document's quality is a linear score of features of its whole text. The weights come from preference
pairs (a document labelled 1 is preferred to one labelled 0): logistic loss on the difference of the two
feature vectors. The cut is a quantile of the scores of the labelled documents, the one that best
separates their labels; the published score is a logistic of the distance to the cut, scaled so that
the cut is exactly ``CUT`` (0.3).

Defined results: a null or empty text is scored like any other text (all its features are 0). A doc_id
labelled both 0 and 1, and null labels or ids, are not learnt from. An id with several texts is learnt from by one of
them. Without labels of both kinds the
score is 0.5 (no labels), 1.0 (only 1s) or 0.0 (only 0s). Repeated rows are scored one by one. Labels,
language, source and id are never features.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_udf, row_groups, text_buffer
from .words import windows, words

CUT = 0.3
MAX_TRAIN_ROWS = 20_000   # the documented bound of the labelled sample the weights are fitted on
PAIRS_PER_ROW = 8
PUNCTUATION = [b for b in range(33, 127) if not chr(b).isalnum()]
_CLASS = np.zeros(256, dtype=np.uint8)      # 0 other, 1 lower, 2 upper, 3 digit, 4 blank, 5 line break, 6 beyond ASCII
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[[9, 11, 12, 13, 32]], _CLASS[10], _CLASS[128:] = 1, 2, 3, 4, 5, 6
for _k, _b in enumerate(PUNCTUATION):
    _CLASS[_b] = 7 + _k
N_CLASSES = 7 + len(PUNCTUATION)
N_FEATURES = N_CLASSES + 8


class Model(NamedTuple):
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    cut: float
    constant: float | None = None   # the score of every text when nothing can be learnt

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = ((x - self.mean) / self.scale) @ self.weights - self.cut
        return 1 / (1 + np.exp(-np.clip(z + math.log(CUT / (1 - CUT)), -500, 500)))


def _repeats(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Share of each text's hashes that the same text has already had."""
    if not len(hashes):
        return np.zeros(len(first) - 1)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    again = np.concatenate([[False], (h[1:] == h[:-1]) & (d[1:] == d[:-1])])
    return np.bincount(d, weights=again, minlength=len(first) - 1) / np.maximum(np.diff(first), 1)


def features(col: pa.Array) -> np.ndarray:
    """One row of ``N_FEATURES`` numbers per text: shares of byte classes, repetition, lengths."""
    raw, off = text_buffer(col)
    out = np.zeros((len(off) - 1, N_FEATURES))
    for i, j in row_groups(off):
        part, o = raw[off[i]:off[j]], off[i:j + 1] - off[i]
        n = j - i
        size = np.diff(o)
        doc = np.repeat(np.arange(n), size)
        counts = np.bincount(doc * N_CLASSES + _CLASS[part], minlength=n * N_CLASSES).reshape(n, N_CLASSES)
        x = out[i:j]
        x[:, :N_CLASSES] = np.sqrt(counts / np.maximum(size, 1)[:, None])
        w = words(part, o)
        n_words = np.diff(w.first)
        pairs, pair_first = windows(w.hashes, w.first, 2)
        triples, triple_first = windows(w.hashes, w.first, 3)
        k = N_CLASSES
        x[:, k] = _repeats(pairs, pair_first)
        x[:, k + 1] = _repeats(triples, triple_first)
        x[:, k + 2] = _repeats(w.hashes, w.first) / np.maximum(np.log1p(n_words), 1)
        x[:, k + 3] = np.log1p((w.ends - w.starts).sum() and
                               np.bincount(np.repeat(np.arange(n), n_words), weights=w.ends - w.starts, minlength=n)
                               / np.maximum(n_words, 1))
        letters = counts[:, 1] + counts[:, 2]
        x[:, k + 4] = counts[:, 2] / np.maximum(letters, 1)
        x[:, k + 5] = counts[:, 7:].sum(axis=1) / np.maximum(n_words, 1)
        x[:, k + 6] = np.minimum(counts[:, 5] / np.maximum(n_words, 1), 1)
        x[:, k + 7] = np.log1p(n_words) / 10
    return out


def preferences(good: np.ndarray, bad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a better and a worse row: ``PAIRS_PER_ROW`` of each row with random ones of the other kind."""
    rng = np.random.default_rng(7)
    left = np.concatenate([np.repeat(good, PAIRS_PER_ROW), rng.choice(good, len(bad) * PAIRS_PER_ROW)])
    return left, np.concatenate([rng.choice(bad, len(good) * PAIRS_PER_ROW), np.repeat(bad, PAIRS_PER_ROW)])


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 25) -> Model:
    """Weights from preference pairs, then the score quantile that best separates the labels."""
    mean, scale = (x.mean(axis=0), x.std(axis=0)) if len(x) else (np.zeros(N_FEATURES), np.ones(N_FEATURES))
    scale = np.where(scale > 1e-9, scale, 1.0)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Model(np.zeros(N_FEATURES), mean, scale, 0.0, 0.5 if not len(y) else float(len(good) > 0))
    left, right = preferences(good, bad)
    z = (x - mean) / scale
    w = np.zeros(N_FEATURES)
    for _ in range(steps):  # Newton steps on the mean logistic loss, pairs in blocks
        grad, hess = ridge * w, ridge * np.eye(N_FEATURES)
        for k in range(0, len(left), 20_000):
            d = z[left[k:k + 20_000]] - z[right[k:k + 20_000]]
            p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))
            grad = grad - d.T @ p / len(left)
            hess = hess + (d * (p * (1 - p))[:, None]).T @ d / len(left)
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    s = z @ w
    order = np.argsort(s, kind="stable")
    below_bad = np.concatenate([[0], np.cumsum(y[order] == 0)])
    below_good = np.concatenate([[0], np.cumsum(y[order] == 1)])
    right_share = below_bad / len(bad) + (len(good) - below_good) / len(good)
    best = np.flatnonzero(right_share >= right_share.max() - 1e-12)
    k = int(best[len(best) // 2])                   # the quantile k / n of the labelled scores
    sorted_s = s[order]
    cut = sorted_s[0] - 1 if k == 0 else sorted_s[-1] + 1 if k == len(s) else (sorted_s[k - 1] + sorted_s[k]) / 2
    return Model(w, mean, scale, float(cut))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """Fit on the labelled documents that are not held out: all of them, or, beyond ``max_rows``, those
    with the smallest hashes of their ids."""
    known = (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("lo"), F.max("quality").alias("hi"))
             .filter("lo = hi").select("doc_id", F.col("lo").alias("y")))
    sample = known.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(max_rows)
    # at most max_rows ids, each with one text: of several, the one with the smallest hash
    texts = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
             .groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")))
    rows = texts.select("doc_id", "y", _features_udf()(F.col("text")).alias("x")).toPandas().sort_values("doc_id")
    x = np.array(rows["x"].tolist(), dtype=float).reshape(len(rows), N_FEATURES)
    return fit(x, rows["y"].to_numpy(dtype=int) if len(rows) else np.zeros(0, int))


def _features_udf():
    @arrow_udf("array<double>")
    def f(text: pa.Array) -> pa.Array:
        x = features(text)
        return pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * N_FEATURES, x.ravel())
    return f


def score_udf(model: Model):
    @arrow_udf("double")
    def f(text: pa.Array) -> pa.Array:
        return pa.array(model.score(features(text)))
    return f


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of ``docs`` as (doc_id, held_out, score, predicted)."""
    model = train(docs, labels)
    return (docs.select("doc_id", score_udf(model)(F.col("text")).alias("score"))
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= CUT).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, train_docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pipeline stage: the rows of ``docs``, all columns, whose text scores at least ``CUT``."""
    model = train(train_docs, labels)
    return docs.filter(score_udf(model)(F.col("text")) >= CUT)
