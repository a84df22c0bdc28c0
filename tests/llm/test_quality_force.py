"""Bradley-Terry fit against plain loops: loss, gradient and cut; and repeated training rows."""

import math

import numpy as np
from pyspark.sql import functions as F

from stratum.llm import quality

RIDGE = 1e-3


def data(n=60, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, quality.N_FEATURES))
    y = (x[:, 0] + 0.5 * x[:, 1] + 0.4 * rng.normal(size=n) > 0).astype(int)
    return x, y


def loss_and_gradient(z, pairs, w):
    """The mean logistic loss on feature differences, one pair and one feature at a time."""
    loss, grad = RIDGE / 2 * sum(a * a for a in w), [RIDGE * a for a in w]
    for i, j in pairs:
        d = [z[i][k] - z[j][k] for k in range(len(w))]
        s = sum(a * b for a, b in zip(d, w))
        loss += math.log1p(math.exp(-s)) / len(pairs)
        for k in range(len(w)):
            grad[k] -= d[k] / (1 + math.exp(s)) / len(pairs)
    return loss, grad


def test_weights_are_where_the_loss_is_least():
    x, y = data()
    model = quality.fit(x, y)
    z = ((x - model.mean) / model.scale).tolist()
    left, right = quality.preferences(np.flatnonzero(y == 1), np.flatnonzero(y == 0))
    pairs = list(zip(left.tolist(), right.tolist()))
    assert all(y[i] == 1 and y[j] == 0 for i, j in pairs) and len(pairs) == quality.PAIRS_PER_ROW * len(y)
    w = model.weights.tolist()
    loss, grad = loss_and_gradient(z, pairs, w)
    assert max(map(abs, grad)) < 1e-5
    rng = np.random.default_rng(1)
    for _ in range(10):
        other = (np.array(w) + 0.01 * rng.normal(size=len(w))).tolist()
        assert loss_and_gradient(z, pairs, other)[0] > loss


def test_the_cut_is_the_quantile_that_separates_best():
    x, y = data(seed=5)
    model = quality.fit(x, y)
    s = [sum(a * b for a, b in zip(row, model.weights)) for row in ((x - model.mean) / model.scale).tolist()]

    def right_share(cut):
        return (sum(v < cut for v, k in zip(s, y) if k == 0) / sum(y == 0) + sum(v >= cut for v, k in zip(s, y) if k == 1) / sum(y == 1))
    edges = sorted(s)
    cuts = [edges[0] - 1, *((a + b) / 2 for a, b in zip(edges, edges[1:])), edges[-1] + 1]
    assert abs(right_share(model.cut) - max(map(right_share, cuts))) < 1e-9


def test_repeated_rows_do_not_change_the_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    once = quality.train(docs, labels)
    again = quality.train(docs.unionByName(docs).unionByName(docs.filter(F.col("doc_id") % 3 == 0)), labels)
    assert np.array_equal(once.weights, again.weights) and once.cut == again.cut
