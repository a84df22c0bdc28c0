"""Co-partitioned tables with Spark's own bucketing: joins on the key and the latest row per key need no exchange.

A table is written once in ``buckets`` files groups by the hash of its key, sorted by the key inside each, and registered with
the session's catalog at a path of the caller's. Tables of one key and number of buckets meet bucket by bucket: neither side is
shuffled, whatever the size of a batch, and a hot key costs what its rows cost to read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from stratum.session import COMPRESSION

BUCKETS = 64


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int = BUCKETS,
                   dealt: bool = False) -> DataFrame:
    """Write ``df`` as the table ``name`` under ``path``, bucketed and sorted by ``keys``; returns the table. Rows that are
    already dealt to ``buckets`` partitions by ``keys`` are not shuffled again; ``dealt`` says so of each part of a union."""
    # one task per bucket writes one file, so a bucket is read as one sorted run (a union: one file for each of its parts)
    ((df if dealt else df.repartition(buckets, *keys)).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
     .option("compression", COMPRESSION).mode("overwrite")
     .saveAsTable(name))
    return df.sparkSession.table(name)


def attach(spark: SparkSession, name: str, path: str, like: DataFrame | StructType, keys: Sequence[str],
           buckets: int = BUCKETS) -> DataFrame:
    """Register a table that another session has written (the catalog of a session without a metastore starts empty)."""
    schema = like if isinstance(like, StructType) else like.schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
              f"INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def latest_per_key(table: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of each key; on a table bucketed by ``keys`` the window runs where the bucket is read."""
    last = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_by])
    return table.withColumn("__n", F.row_number().over(last)).filter("__n = 1").drop("__n")
