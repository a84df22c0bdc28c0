"""Shared helpers: scratch tables on shared storage, table loading, Arrow text batches."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_shipped: set[str] = set()


ROWS_PER_BATCH = "1000"


def ship(spark: SparkSession) -> None:
    """Give the executors this package once per application, wherever the driver's own copy lies.

    Also keeps Arrow batches of whole texts small, unless the session says otherwise: Spark's default of 10,000 rows
    takes memory outside the heap in proportion to the texts."""
    sc = spark.sparkContext
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows, "10000") == "10000":
        spark.conf.set(rows, ROWS_PER_BATCH)
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(prefix="stratum-"), "stratum_code.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(os.path.join(root, "stratum")):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def arrow_udf(return_type: str):
    """``F.arrow_udf`` for functions of this package."""
    ship(SparkSession.active())
    return F.arrow_udf(return_type)


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` for functions of this package."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new folder under the session's shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}/{tag}"


def written(df: DataFrame, tag: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a table on shared storage and read it back: lineage ends there, lost executors
    cost only the tasks they ran, and later joins see real sizes (AQE can split or broadcast)."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """The installed vocabulary file of that name; it is the same on every machine of the cluster."""
    import public_tokenizers
    return public_tokenizers.path(name)


def ascii_lower(col):
    """A-Z to a-z and nothing else (``lower`` would change other alphabets)."""
    return F.translate(col, UPPER, LOWER)


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column without making Python strings; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        kind = np.int64
    else:
        kind = np.int32
    if col.null_count:
        col = col.fill_null("" if not pa.types.is_binary(col.type) else b"")
    n = len(col)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=kind)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_groups(offsets: np.ndarray, most: int = 1 << 20):
    """Consecutive row ranges of about ``most`` bytes of text each; a longer row stands alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = max(i + 1, min(j, n))
        yield i, j
        i = j
