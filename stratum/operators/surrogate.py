"""M6: dense surrogate keys assigned in parallel, in natural-key order.

There is no identity column on parquet tables and a global ``row_number()`` would run in a single
task. Instead: range-partition the new rows by the order columns, sort inside each partition and write
that layout, with each row's partition number and position, to shared storage (it must not change
between counting and numbering). The per-partition row counts (one number per partition, so bounded by the
partition count, not the data) give each partition its starting offset, joined by partition number; the
position comes from ``monotonically_increasing_id``. The result equals
``base + row_number() OVER (ORDER BY order_cols)`` without funnelling rows through one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stratum.session import COMPRESSION, ensure_checkpoint_dir


def max_key(df: DataFrame, sk_col: str) -> int:
    """Largest key already handed out (0 for an empty table)."""
    v = df.agg(F.max(sk_col)).first()[0]
    return int(v) if v is not None else 0


def assign_surrogate_keys(df: DataFrame, order_cols: Sequence[str | Column], sk_col: str,
                          base: int = 0, num_partitions: int | None = None) -> DataFrame:
    return assign_surrogate_keys_counted(df, order_cols, sk_col, base, num_partitions)[0]


def assign_surrogate_keys_counted(df: DataFrame, order_cols: Sequence[str | Column], sk_col: str,
                                  base: int = 0, num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """As :func:`assign_surrogate_keys`, also returning how many keys were handed out."""
    spark = df.sparkSession
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    # Without an explicit count AQE may coalesce *adjacent* range partitions, which keeps the global
    # order: a handful of new rows no longer costs hundreds of tasks, a large batch keeps its parallelism.
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    pid = F.spark_partition_id()
    numbered = ranged.sortWithinPartitions(*order).select(
        *[c for c in df.columns if c != sk_col], pid.alias("__pid"),
        (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)).alias("__pos"))
    # written once: a partition's number and its rows' positions come from one committed task attempt
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/keys/{uuid.uuid4().hex}"
    numbered.write.parquet(path, compression=COMPRESSION)
    laid_out = spark.read.schema(numbered.schema).parquet(path)
    counts = sorted(laid_out.groupBy("__pid").count().collect())    # one row per partition
    offsets, running = [], 0
    for part, n in counts:
        offsets.append((part, running))
        running += n
    if not offsets:
        return laid_out.select(F.lit(None).cast("long").alias(sk_col), *[c for c in df.columns if c != sk_col]), 0
    starts = spark.createDataFrame(offsets, "__p int, __offset long")
    sk = (F.lit(base).cast("long") + F.col("__offset") + F.col("__pos") + 1).alias(sk_col)
    return (laid_out.join(F.broadcast(starts), F.col("__pid") == F.col("__p"))      # one row per partition
            .select(sk, *[F.col(c) for c in df.columns if c != sk_col])), running
