"""N-gram Jaccard self-join: MinHash banding for candidates, full n-gram sets for the verdict.

Two documents are linked if the Jaccard similarity of their sets of word 5-grams is at least 0.8. Words are
runs of letters and digits, A-Z lower-cased (``words``).

1. Documents with one n-gram set are one class; copies are counted, never paired.
2. Each class gets ``bands`` hashes of ``rows`` MinHash values, the numbers chosen for the target recall at
   the threshold. Classes that share a band hash form a bucket. Buckets with the same members in several
   bands are taken once.
3. The n-gram sets of classes in buckets are computed again from the texts and shuffled to their buckets. A
   bucket of more than ``BLOCK`` classes, or of large sets, is dealt into blocks by hash, and each
   pair of blocks is a task of its own, so no task gets an unbounded group. A task counts each document's
   links and gives one spanning edge per linked class: rows for all pairs are never made. A pair that meets
   in several bands counts in the first only.
4. Connected components of the spanning edges (alternating large and small stars, a table written per
   round) give the groups of near duplicates.

Defined results: rows with a null doc_id take no part (class and links null). Texts without words are one
class of copies; a text of one to four words has one n-gram, all its words. Rows with one doc_id and
different texts are judged one by one. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_udf, map_arrow, row_groups, text_buffer, written
from .words import mix, windows, words

N, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.999, 64
BLOCK = 1024                    # classes of a bucket that one task compares with as many others
BLOCK_VALUES = 1 << 20          # n-grams of those, 8 MB


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, so the fewest false candidates, whose bands find a pair at the
    threshold with probability ``recall`` within ``max_hashes`` hashes."""
    best = None
    for rows in range(1, max_hashes + 1):
        p = threshold ** rows
        bands = 1 if p >= recall else int(np.ceil(np.log(1 - recall) / np.log1p(-p)))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("no banding reaches this recall within max_hashes")
    return best


def _ngram_sets(col: pa.Array, n: int):
    """For each text its sorted distinct n-gram hashes: (values, first), in batches of rows."""
    raw, off = text_buffer(col)
    for i, j in row_groups(off):
        w = words(raw[off[i]:off[j]], off[i:j + 1] - off[i])
        grams, first = windows(w.hashes, w.first, n)
        doc = np.repeat(np.arange(j - i), np.diff(first))
        order = np.lexsort((grams, doc))
        grams, doc = grams[order], doc[order]
        if len(grams):
            new = np.concatenate([[True], (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])])
            grams, doc = grams[new], doc[new]
        yield i, j, grams, np.searchsorted(doc, np.arange(j - i + 1))


def _band_hashes(grams: np.ndarray, first: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """``bands`` hashes (int64) of every set; sets must not be empty."""
    rng = np.random.default_rng(11)
    flip = rng.integers(1, 1 << 63, size=bands * rows, dtype=np.uint64)
    times = rng.integers(1, 1 << 62, size=bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((len(first) - 1, bands), dtype=np.uint64)
    for b in range(bands):
        h = np.full(len(first) - 1, b + 1, dtype=np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            h = mix(h + np.minimum.reduceat((grams ^ flip[k]) * times[k], first[:-1]))
        out[:, b] = h
    return out.view(np.int64)


def _signatures(n: int, bands: int, rows: int, with_sets: bool):
    def run(batches):
        for batch in batches:
            for i, j, grams, first in _ngram_sets(batch.column(1), n):
                sizes = np.diff(first)
                some = np.flatnonzero(sizes)
                keys = [xxhash.xxh3_128_digest(grams[first[k]:first[k + 1]].tobytes()) for k in range(j - i)]
                hashes = np.zeros(0, dtype=np.int64)
                if len(some):
                    hashes = _band_hashes(grams, np.append(first[:-1][some], len(grams)), bands, rows).ravel()
                at = np.concatenate([[0], np.cumsum((sizes > 0) * bands)]).astype(np.int32)
                cols = [batch.column(0).slice(i, j - i), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()),
                        pa.ListArray.from_arrays(at, pa.array(hashes))]
                names = ["doc_id", "key", "n", "bands"]
                if with_sets:
                    cols.append(pa.array([grams[first[k]:first[k + 1]].tobytes() for k in range(j - i)], pa.binary()))
                    names.append("grams")
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def _linked(sets: list[np.ndarray], threshold: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each set the (numbers, of sets that come after it, whose Jaccard similarity reaches ``threshold``)."""
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    _, start, inverse, df = np.unique(values[order], return_index=True, return_inverse=True, return_counts=True)
    posting = owner[order]
    of_value = np.empty(len(values), dtype=np.int64)
    of_value[order] = inverse
    at = np.concatenate([[0], np.cumsum(sizes)])
    out = []
    for i in range(len(sets)):
        ids = of_value[at[i]:at[i + 1]]
        ids = ids[df[ids] > 1]
        lengths = df[ids]
        total = int(lengths.sum())
        if not total:
            out.append(np.zeros(0, dtype=np.int64))
            continue
        skip = np.repeat(start[ids] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        both = np.bincount(posting[np.arange(total) + skip], minlength=len(sets))
        both[:i + 1] = 0
        near = np.flatnonzero(both)
        union = sizes[i] + sizes[near] - both[near]
        out.append(near[both[near] >= threshold * union - 1e-9])
    return out


def _verify(threshold: float):
    """Of one bucket's block pair: (key, links, root) of each class that has a link there."""
    def judge(group: dict, rows: list[dict]):
        seen, mine = set(), []
        for r in rows:
            if r["key"] not in seen:
                seen.add(r["key"])
                mine.append(r)
        sets = [np.frombuffer(r["grams"], dtype=np.uint64) for r in mine]
        bands = np.array([r["bands"] for r in mine])
        copies = np.array([r["copies"] for r in mine])
        block = np.array([r["block"] for r in mine])
        links, root = np.zeros(len(mine), dtype=np.int64), list(range(len(mine)))

        def top(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for i, near in enumerate(_linked(sets, threshold)):
            if group["left"] != group["right"]:
                near = near[block[near] != block[i]]
            if not len(near):
                continue
            near = near[np.argmax(bands[near] == bands[i], axis=1) == group["band"]]
            links[i] += copies[near].sum()
            links[near] += copies[i]
            for j in near:
                a, b = top(i), top(int(j))
                if a != b:
                    root[max(a, b)] = min(a, b)
        hit = np.flatnonzero(links)
        return ([mine[k]["key"] for k in hit], links[hit], [mine[top(k)]["key"] for k in hit])

    names = ("band", "hash", "left", "right")

    def run(batches):
        group, rows, out = None, [], ([], [], [])

        def close():
            if len(rows) > 1:
                for mine, new in zip(out, judge(dict(zip(names, group, strict=True)), rows), strict=True):
                    mine.extend(new)

        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                for r in whole.slice(at, 1024).to_pylist():
                    own = tuple(r[c] for c in names)
                    if own != group:
                        close()
                        group, rows = own, []
                    rows.append(r)
            if len(out[0]) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()),
                                                  pa.array(out[2], pa.binary())], names=["key", "links", "root"])
                out = ([], [], [])
        close()
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()),
                                          pa.array(out[2], pa.binary())], names=["key", "links", "root"])
    return run


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): root is the smallest node of each connected component of ``edges`` (a, b).

    Alternating large and small stars: each node hands its neighbours to the smallest of them. Hot nodes
    only meet aggregates that are computed in every task first, and joins that AQE may split."""
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .filter("a <> b").distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("m"))
                        .select(F.col("a").alias("u"), F.least("a", "m").alias("m")), "least")
        large = (both.join(least, both["a"] == least["u"]).filter("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        large = written(large, "large")
        least = written(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u"), "least")
        small = (large.join(least, large["a"] == least["u"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())
        edges = written(small, "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("connected components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Every row of ``docs`` as (doc_id, class_id, rep_id, n_links).

    ``rep_id``: the smallest doc_id with the same n-gram set. ``class_id``: the smallest doc_id of the group
    of near duplicates (connected by links). ``n_links``: how many other rows are linked to it, copies
    included."""
    rest = (docs.filter("doc_id IS NULL").select(F.col("doc_id").cast("long").alias("doc_id"))
            .selectExpr("doc_id", "cast(null AS long) AS class_id", "cast(null AS long) AS rep_id",
                        "cast(null AS long) AS n_links"))
    return _judged(docs, n, threshold, recall).drop("key").unionByName(rest)


def _judged(docs: DataFrame, n: int, threshold: float, recall: float) -> DataFrame:
    """(doc_id, key, class_id, rep_id, n_links) of every row with a doc_id."""
    bands, rows = choose_bands(threshold, recall)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = own.filter("doc_id IS NOT NULL")
    schema = "doc_id long, key binary, n int, bands array<long>"
    signed = written(map_arrow(known, _signatures(n, bands, rows, False), schema), "signatures")
    classes = written(signed.groupBy("key").agg(F.min("doc_id").alias("rep_id"), F.count(F.lit(1)).alias("copies"),
                                                F.first("n").alias("n"), F.first("bands").alias("bands")), "classes")

    spread = classes.select("key", "rep_id", "copies", "n", F.posexplode("bands").alias("band", "hash"))
    whole = (spread.groupBy("band", "hash")
             .agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("size"), F.bit_xor(F.xxhash64("key")).alias("x"),
                  F.bit_xor(F.xxhash64(F.lit(1), "key")).alias("y")).filter("k > 1"))
    kept = written(whole.groupBy("k", "size", "x", "y").agg(F.min(F.struct("band", "hash")).alias("g"))
                   .select(F.col("g.band").alias("gb"), F.col("g.hash").alias("gh"),
                           F.greatest(F.ceil(F.col("k") / BLOCK), F.ceil(F.col("size") / BLOCK_VALUES)).cast("int")
                           .alias("blocks")), "buckets")
    members = (spread.join(kept, (spread["band"] == kept["gb"]) & (spread["hash"] == kept["gh"]))
               .withColumn("block", F.pmod(F.xxhash64(F.lit(2), "key"), F.col("blocks")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
               .select("key", "rep_id", "copies", "band", "hash", "block", F.least("block", "other").alias("left"),
                       F.greatest("block", "other").alias("right")))
    members = written(members, "members")

    wanted = members.select(F.col("rep_id").alias("doc_id")).distinct()
    sets = map_arrow(known.join(wanted, "doc_id", "left_semi"), _signatures(n, bands, rows, True),
                     schema + ", grams binary").select(F.col("key").alias("k"), "bands", "grams")
    dealt = (members.drop("rep_id").join(sets, members["key"] == sets["k"]).drop("k")
             .repartition("band", "hash", "left", "right")
             .sortWithinPartitions("band", "hash", "left", "right", "key"))
    links = written(map_arrow(dealt, _verify(threshold), "key binary, links long, root binary"), "links")

    roots = components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("key").agg(F.sum("links").alias("links"))
    placed = (classes.select("key", "rep_id", "copies").join(counted, "key", "left")
              .join(roots, F.col("key") == F.col("node"), "left")
              .select("key", "rep_id", "copies", F.coalesce("links", F.lit(0)).alias("links"),
                      F.coalesce("root", "key").alias("root")))
    placed = written(placed, "placed")
    smallest = placed.groupBy("root").agg(F.min("rep_id").alias("class_id"))
    verdict = written(placed.join(smallest, "root")
                      .select("key", "class_id", "rep_id", (F.col("links") + F.col("copies") - 1).alias("n_links")),
                      "verdict")
    return signed.select("doc_id", "key").join(verdict, "key").select("doc_id", "key", "class_id", "rep_id", "n_links")


def _key_udf(n: int):
    @arrow_udf("binary")
    def key(text: pa.Array) -> pa.Array:
        return pa.array([xxhash.xxh3_128_digest(grams[first[k]:first[k + 1]].tobytes())
                         for i, j, grams, first in _ngram_sets(text, n) for k in range(j - i)], pa.binary())
    return key


def one_of_each(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Pipeline stage: the rows of ``docs``, all columns, whose doc_id is the smallest of its group of near
    duplicates. Rows without a doc_id stay; rows that repeat both doc_id and n-gram set stay or go together."""
    lost = (_judged(docs, n, threshold, recall).filter("doc_id <> class_id")
            .select(F.col("doc_id").alias("__lost"), F.col("key").alias("__lost_key")))
    keyed = docs.withColumn("__key", _key_udf(n)(F.col("text")))
    return (keyed.join(lost, (keyed["doc_id"] == lost["__lost"]) & (keyed["__key"] == lost["__lost_key"]), "left_anti")
            .drop("__key"))
