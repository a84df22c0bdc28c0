"""T4/T5: change rows between two snapshots of a keyed table.

An update is reported the way the warehouse's table streams report it: a DELETE of the old row
plus an INSERT of the new one, both flagged ``metadata_is_update``. Unchanged rows emit nothing.
One full outer join on the key; rows are compared null-safely on every non-key column.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


BUCKET = "key_bucket"


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    cols = new.columns
    values = [c for c in cols if c not in keys]
    o = old.select(*[F.col(c).alias("__o_" + c) for c in cols], F.lit(True).alias("__o"))
    n = new.select(*[F.col(c).alias("__n_" + c) for c in cols], F.lit(True).alias("__n"))
    on = reduce(lambda a, b: a & b, [F.col("__o_" + k) == F.col("__n_" + k) for k in keys])
    j = o.join(n, on, "full_outer")
    op, np_ = F.col("__o").isNotNull(), F.col("__n").isNotNull()
    differs = reduce(lambda a, b: a | b, [~F.col("__o_" + c).eqNullSafe(F.col("__n_" + c)) for c in values],
                     F.lit(False))
    is_update = op & np_ & differs
    old_row = F.struct(*[F.col("__o_" + c).alias(c) for c in cols], F.lit("DELETE").alias("metadata_action"),
                       is_update.alias("metadata_is_update"))
    new_row = F.struct(*[F.col("__n_" + c).alias(c) for c in cols], F.lit("INSERT").alias("metadata_action"),
                       is_update.alias("metadata_is_update"))
    emitted = F.array(F.when(op & (~np_ | is_update), old_row), F.when(np_ & (~op | is_update), new_row))
    return (j.select(F.explode(F.filter(emitted, lambda r: r.isNotNull())).alias("r"))
            .select("r.*"))


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` with the bucket of each key, to be stored as a partition column."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def bucket_digests(bucketed: DataFrame) -> DataFrame:
    """(bucket, n, digest): rows and an order-free digest of all columns of each bucket, one row per bucket."""
    cols = [c for c in sorted(bucketed.columns) if c != BUCKET]
    return bucketed.groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("digest"))


def change_feed_by_digest(old: DataFrame, new: DataFrame, old_digests: DataFrame, new_digests: DataFrame,
                          keys: Sequence[str]) -> DataFrame:
    """:func:`change_feed` of two snapshots stored by bucket, with their digests: only buckets whose digests differ are read
    (partition pruning at run time) and compared row by row."""
    o, n = old_digests.select(F.col(BUCKET).alias("b"), F.col("n").alias("on"), F.col("digest").alias("od")), new_digests
    both = o.join(n, F.col("b") == F.col(BUCKET), "full_outer")
    differs = both.filter(~(F.col("on").eqNullSafe(F.col("n")) & F.col("od").eqNullSafe(F.col("digest")))).select(
        F.coalesce("b", BUCKET).alias("__differs"))
    # at most one number per bucket
    which = [r["__differs"] for r in differs.collect()]
    part = lambda df: df.filter(F.col(BUCKET).isin(which) if which else F.lit(False)).drop(BUCKET)
    return change_feed(part(old), part(new), keys)


def inserts_only(changes: DataFrame) -> DataFrame:
    """T5: keep the inserted side of the change rows (``METADATA$ACTION = 'INSERT'``)."""
    return changes.filter(F.col("metadata_action") == "INSERT")
