"""Joins under a hot key: frequent keys are found by a sketch, their few dimension rows are broadcast, the rest is shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

MOST_HEAVY = 64       # keys that may count as hot: the bound of everything that is broadcast or written into a plan
SHARE = 0.01          # of the rows, from which on a key is hot


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float = SHARE) -> list[int]:
    """Hashes of the keys that hold at least about ``share`` of the rows, at most ``MOST_HEAVY``, by a frequent-items sketch
    (one pass, merged across tasks). A key that the sketch misses or adds changes no result, only how it is joined."""
    top = F.expr(f"approx_top_k(__key, {MOST_HEAVY}, {64 * MOST_HEAVY})")
    r = df.select(key_hash(keys).alias("__key")).agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    return [t["item"] for t in r["top"] or () if t["count"] >= max(share * r["n"], 2)]


def hot_key_join(facts: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "left",
                 heavy: list[int] | None = None) -> DataFrame:
    """``facts.join(dim, keys, how)`` (inner or left) for a ``dim`` with one row per key. Rows of a hot key meet its one
    dimension row by broadcast (at most ``MOST_HEAVY`` rows) where they are; NULL keys, which match nothing, may be hot."""
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    keys = list(keys)
    heavy = heavy_keys(facts, keys) if heavy is None else heavy
    if not heavy:
        return facts.join(dim, keys, how)
    hot = key_hash(keys).isin(heavy)
    few = facts.filter(hot).join(F.broadcast(dim.filter(hot)), keys, how)
    rest = facts.filter(~hot).join(dim.filter(~hot), keys, how)
    return few.unionByName(rest)
