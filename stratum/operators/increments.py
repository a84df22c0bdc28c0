"""Aggregates that are merged from the changes of each run instead of being computed again.

* Signed sums (A2): a changed row counts +1 with its new values and -1 with its old ones; a run's partial sums are added.
* Exact distinct counts (A3): one bitmap row per group and block of 32,768 keys, made with Spark's bitmap aggregates; runs
  are merged by OR, so no run is scanned again. Keys are non-negative numbers; dense ones, such as surrogate keys, make the
  fullest bitmaps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def signed_sums(new: DataFrame, old: DataFrame | None, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """(by, n_rows, sums): what a run adds to each group. ``new`` are the rows it wrote, ``old`` the rows they replace."""
    rows = new.select(*by, *sums, F.lit(1).alias("sign"))
    if old is not None:
        rows = rows.unionByName(old.select(*by, *[(-F.col(c)).alias(c) for c in sums], F.lit(-1).alias("sign")))
    return rows.groupBy(*by).agg(F.sum("sign").alias("n_rows"), *[F.sum(c).alias(c) for c in sums])


def merged_sums(partials: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """The groups that have rows, from the partial sums of any number of runs."""
    return (partials.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), *[F.sum(c).alias(c) for c in sums])
            .filter("n_rows > 0"))


def distinct_bitmaps(df: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """(by, block, bits): the keys of each group as bitmaps of 4 KB. NULL keys do not count, as in COUNT(DISTINCT); a group
    with no other key has one empty bitmap."""
    block = F.coalesce(F.expr(f"bitmap_bucket_number({key})"), F.lit(1).cast("long"))
    at = F.expr(f"bitmap_bit_position({key})")
    return df.groupBy(*by, block.alias("block")).agg(F.bitmap_construct_agg(at).alias("bits"))


def merged_distinct(bitmaps: DataFrame, by: Sequence[str], name: str = "n_distinct") -> DataFrame:
    """(by, name): the exact distinct count of each group over all runs' bitmaps."""
    whole = bitmaps.groupBy(*by, "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    return whole.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).cast("long").alias(name))
