"""Exact top-k search by inner product over a pivot-distance index.

Components x become the integers floor(256 x). Largest inner products are nearest neighbours once every vector gets
one more component, sqrt(M^2 - |v|^2) with M the largest norm, and every query a 0 there: the squared distance is
|q|^2 + M^2 - 2 q.v.

Index. Pivots are fitted on a bounded sample (``SAMPLE`` vectors with the smallest hashes of their ids; a few rounds of
k-means). Every vector is keyed by its nearest pivot and its distance to it; the index is range-partitioned and sorted
by (pivot, distance, id), so equal vectors are dealt out by id, and cut into blocks: annuli of at most ``BLOCK`` vectors
around one pivot. Queries are blocked the same way.

Search, in two waves. First each block of queries meets the annuli of its pivot that hold its own distances, which
gives every query a k-th best score. By the triangle inequality an annulus [a, b] around p holds nothing closer to q than
max(d(q, p) - b, a - d(q, p)); so the second wave takes, for each pivot, the annuli that the bound leaves, nearest first,
and drops the rest. Scores are exact integers; ties go to the smaller id. Blocks travel whole and every pair of
blocks is a row of a shuffle, so no task holds more than it is given.

Defined results: null vectors, vectors with null or non-finite components and null ids take no part. Shorter vectors
count as padded with zeros. Equal ids are different rows, but a query's own id is never its candidate. Scores have to
fit 64 bits. Fewer than k candidates give fewer rows; empty tables give none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, written

SCALE = 256
SAMPLE, MAX_PIVOTS, ROUNDS = 4096, 64, 8
BLOCK, QUERY_BLOCK = 1024, 128
SLACK = 1e-6                 # relative, on distances: rounding never drops an annulus


def _integers(rows: list, dim: int) -> np.ndarray:
    out = np.zeros((len(rows), dim), dtype=np.float64)
    for k, r in enumerate(rows):
        out[k, :len(r)] = r
    return np.floor(SCALE * out)


def _vectors(data: bytes, kind: str, dim: int) -> np.ndarray:
    return np.frombuffer(data, dtype=kind).reshape(-1, dim).astype(np.float64)


def _distances(v: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances of (v, extra) to the pivots (whose last component is the extra one)."""
    d = ((v ** 2).sum(axis=1) + extra ** 2)[:, None] + (pivots ** 2).sum(axis=1)[None, :]
    d -= 2 * (v @ pivots[:, :-1].T + extra[:, None] * pivots[:, -1][None, :])
    return np.sqrt(np.maximum(d, 0))


def _extra(v: np.ndarray, top: float) -> np.ndarray:
    return np.sqrt(np.maximum(top - (v ** 2).sum(axis=1), 0))


def fit_pivots(sample: np.ndarray, top: float, n: int) -> np.ndarray:
    """``n`` pivots at most: distinct sample vectors far from each other, moved by a few rounds of k-means."""
    x = np.unique(np.hstack([sample, _extra(sample, top)[:, None]]), axis=0)
    chosen = [0]
    near = np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < min(n, len(x)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(x - x[chosen[-1]], axis=1))
    pivots = x[chosen]
    for _ in range(ROUNDS):
        own = _distances(x[:, :-1], x[:, -1], pivots).argmin(axis=1)
        pivots = np.array([x[own == k].mean(axis=0) if (own == k).any() else pivots[k] for k in range(len(pivots))])
    return pivots


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors, exactly: float64 while every sum stays below 2**53, else integers."""
    most = (np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0)) * queries.shape[1]
    if most < 2 ** 53:
        return (queries @ vectors.T).astype(np.int64)
    exact = lambda a: np.array([[int(x) for x in r] for r in a], dtype=object).reshape(a.shape)
    return (exact(queries) @ exact(vectors).T).astype(np.int64)


def _keyed(pivots, top: float, dim: int, kind: str):
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                v = _integers(batch.column(1).to_pylist(), dim)
                d = _distances(v, _extra(v, top), pivots.value)
                own = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(own, pa.int32()), pa.array(d[np.arange(len(v)), own], pa.float64()),
                     pa.array([r.tobytes() for r in v.astype(kind)], pa.binary())], names=["id", "pivot", "distance", "v"])
    return run


def _blocks(size: int):
    """Sorted rows to numbered blocks of consecutive rows of one pivot."""
    def pack(pivot, rows, number):
        ids, dist = np.array([r[0] for r in rows], dtype=np.int64), [r[1] for r in rows]
        data = b"".join(r[2] for r in rows)
        cols = {"block": pa.array([(TaskContext.get().partitionId() << 32) + number], pa.int64()), "pivot": pa.array([pivot], pa.int32()), "lo": pa.array([min(dist)], pa.float64()),
                "hi": pa.array([max(dist)], pa.float64()), "ids": pa.array([ids.tobytes()], pa.binary()),
                "data": pa.array([data], pa.binary())}
        return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    def run(batches):
        pivot, rows, number = None, [], 0
        for b in batches:
            for own, *row in zip(b.column(0).to_pylist(), *(b.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                if rows and (own != pivot or len(rows) == size):
                    yield pack(pivot, rows, number)
                    rows, number = [], number + 1
                pivot = own
                rows.append(row)
        if rows:
            yield pack(pivot, rows, number)
    return run


BLOCKS = "block long, pivot int, lo double, hi double, ids binary, data binary"


def _best(queries, q_ids, vectors, ids, k: int):
    """Rows (query, id, score) of each query's ``k`` best of one block."""
    s = scores(queries, vectors)
    out_q, out_i, out_s = [], [], []
    for n in range(len(q_ids)):
        ok = np.flatnonzero(ids != q_ids[n])
        if len(ok) > k:
            cut = np.partition(s[n][ok], len(ok) - k)[len(ok) - k]
            ok = ok[s[n][ok] >= cut]
        ok = ok[np.lexsort((ids[ok], -s[n][ok]))][:k]
        out_q += [int(q_ids[n])] * len(ok)
        out_i += ids[ok].tolist()
        out_s += s[n][ok].tolist()
    return out_q, out_i, out_s


def _pairs(k: int, dim: int, pivots, top: float, kind: str):
    """Rows of block pairs to candidates; ``radius`` (per query, or null) and the annulus drop queries first."""
    def run(batches):
        for whole in batches:
            for at in range(whole.num_rows):
                r = {n: whole.column(n)[at].as_py() for n in whole.schema.names}
                q = _vectors(r["q_data"], kind, dim)
                q_ids = np.frombuffer(r["q_ids"], dtype=np.int64)
                if r["q_bound"] is not None:
                    bound = np.frombuffer(r["q_bound"])           # the k-th best score so far, or -inf
                    radius = _radius(q, bound, top)
                    d = _distances(q, np.zeros(len(q)), pivots.value[r["pivot"]:r["pivot"] + 1])[:, 0]
                    near = np.maximum(d - r["hi"], r["lo"] - d) <= radius
                    q, q_ids = q[near], q_ids[near]
                if not len(q_ids):
                    continue
                got = _best(q, q_ids, _vectors(r["data"], kind, dim), np.frombuffer(r["ids"], dtype=np.int64), k)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in got], names=["query_id", "vec_id", "score"])
    return run


def _radius(q: np.ndarray, bound: np.ndarray, top: float) -> np.ndarray:
    """How far a vector may be from each query and still reach its bound."""
    square = (q ** 2).sum(axis=1) + top - 2 * bound
    return np.sqrt(np.maximum(square, 0)) * (1 + SLACK) + SLACK * (1 + np.sqrt(top))


def _ranges(dim: int, n_pivots: int, pivots, top: float, kind: str):
    """Blocks of queries with bounds to rows (q_block, pivot, reach_lo, reach_hi)."""
    def run(batches):
        for whole in batches:
            for at in range(whole.num_rows):
                r = {n: whole.column(n)[at].as_py() for n in whole.schema.names}
                q = _vectors(r["q_data"], kind, dim)
                radius = _radius(q, np.frombuffer(r["q_bound"]), top)
                d = _distances(q, np.zeros(len(q)), pivots.value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["q_block"]] * n_pivots, pa.int64()), pa.array(np.arange(n_pivots), pa.int32()),
                     pa.array((d - radius[:, None]).min(axis=0)), pa.array((d + radius[:, None]).max(axis=0))],
                    names=["r_block", "r_pivot", "reach_lo", "reach_hi"])
    return run


def search(vectors: DataFrame, is_query, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of every row with ``is_query`` (a condition
    on ``vec_id``) with all other rows of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    clean = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
             .filter("vec_id IS NOT NULL AND e IS NOT NULL")
             .filter(F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))))
    result = "query_id long, rank int, vec_id long, score long"
    squares = F.aggregate("e", F.lit(0.0), lambda s, x: s + F.floor(x * SCALE).cast("double") * F.floor(x * SCALE).cast("double"))
    largest = F.array_max(F.transform("e", lambda x: F.abs(F.floor(x * SCALE).cast("double"))))
    n, dim, top, most = clean.agg(F.count(F.lit(1)), F.max(F.size("e")), F.max(squares), F.max(largest)).first()
    if not n:
        return spark.createDataFrame([], result)
    dim, top = max(int(dim), 1), float(top or 0.0) * (1 + 1e-12)
    kind = "<i2" if (most or 0.0) < 1 << 15 else "<f8"      # how components travel; both hold them exactly
    sample = clean.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("e").collect()   # at most SAMPLE vectors
    fitted = fit_pivots(_integers([r[0] for r in sample], dim), top, max(1, min(MAX_PIVOTS, int(n ** 0.5) // 4)))
    pivots = spark.sparkContext.broadcast(fitted)       # at most MAX_PIVOTS vectors

    keyed = written(map_arrow(clean, _keyed(pivots, top, dim, kind), "id long, pivot int, distance double, v binary"), "keyed")

    def blocked(rows, size, tag):
        ordered = rows.select("pivot", "id", "distance", "v").repartitionByRange("pivot", "distance", "id")
        ordered = ordered.sortWithinPartitions("pivot", "distance", "id")
        return written(map_arrow(ordered, _blocks(size), BLOCKS), tag)

    index = blocked(keyed, BLOCK, "index")
    asked = (blocked(keyed.filter(is_query(F.col("id"))), QUERY_BLOCK, "queries")
             .select(F.col("block").alias("q_block"), F.col("pivot").alias("q_pivot"), F.col("lo").alias("q_lo"),
                     F.col("hi").alias("q_hi"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data")))
    rings = index.select(F.col("block").alias("i_block"), "pivot", "lo", "hi")

    def wave(pairs, queries):
        """Candidates of block pairs (q_block, i_block); each pair carries its two blocks through the shuffle."""
        with_q = pairs.join(queries, "q_block")
        with_both = with_q.join(index.select(F.col("block").alias("b"), "pivot", "lo", "hi", "ids", "data"),
                                F.col("i_block") == F.col("b"))
        sides = with_both.select("pivot", "lo", "hi", "q_ids", "q_data", "q_bound", "ids", "data")
        return map_arrow(sides.repartition(F.xxhash64("lo", "hi", "pivot", F.col("q_ids"))), _pairs(k, dim, pivots, top, kind),
                         "query_id long, vec_id long, score long")

    # One block of queries spans distances q_lo..q_hi of its own pivot: the annuli there, and the nearest one.
    home = (asked.select("q_block", "q_pivot", "q_lo", "q_hi")
            .join(rings, (F.col("q_pivot") == F.col("pivot")) & (F.col("lo") <= F.col("q_hi")) & (F.col("hi") >= F.col("q_lo")))
            .select("q_block", "i_block"))
    home = written(home, "home")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    first = written(wave(home, asked.withColumn("q_bound", F.lit(None).cast("binary")))
                    .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k), "first")
    kth = first.filter(F.col("rank") == k).select(F.col("query_id").alias("b_id"), F.col("score").alias("b_score"))

    def ids_of(batches):
        for b in batches:
            for block, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = np.frombuffer(ids, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(own), pa.int64()), pa.array(np.arange(len(own)), pa.int32()),
                                                  pa.array(own)], names=["m_block", "place", "m_id"])

    def bounds(batches):
        for b in batches:
            for block, held in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                value = np.array([-np.inf if h["b_score"] is None else h["b_score"] for h in held], dtype=np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([value.tobytes()], pa.binary())],
                                                 names=["m_block", "q_bound"])

    member = map_arrow(asked.select("q_block", "q_ids"), ids_of, "m_block long, place int, m_id long")
    bound = map_arrow(member.join(kth, F.col("m_id") == F.col("b_id"), "left").groupBy("m_block")
                      .agg(F.sort_array(F.collect_list(F.struct("place", "b_score"))).alias("held")),   # QUERY_BLOCK rows
                      bounds, "m_block long, q_bound binary")
    bounded = written(asked.join(bound, F.col("q_block") == F.col("m_block")).drop("m_block"), "bounded")
    reach = map_arrow(bounded.select("q_block", "q_data", "q_bound"), _ranges(dim, len(fitted), pivots, top, kind),
                      "r_block long, r_pivot int, reach_lo double, reach_hi double")
    left = (reach.join(rings, (F.col("r_pivot") == F.col("pivot")) & (F.col("lo") <= F.col("reach_hi"))
                       & (F.col("hi") >= F.col("reach_lo")))
            .select(F.col("r_block").alias("q_block"), "i_block")
            .join(home, ["q_block", "i_block"], "left_anti"))
    rest = wave(written(left, "left"), bounded)
    every = first.select("query_id", "vec_id", "score").unionByName(rest)
    return (every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
