"""Per-session memo of materialised snapshots, so several reports share one pipeline run.

A snapshot is materialised as a parquet table in the session's shared checkpoint directory: that
cuts the lineage between runs exactly where a production run commits a table version, survives
executor loss, costs one pass (a reliable ``checkpoint()`` computes its plan twice unless cached)
and is read back with column pruning and filter push-down.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from stratum.operators.scd2 import scd2_commit
from stratum.session import COMPRESSION, ensure_checkpoint_dir

_MEMO: dict[tuple, object] = {}
_CREATED: list[tuple[SparkSession, str]] = []   # folders this process wrote (snapshots, tables)
_LOCKS: dict[tuple, threading.Lock] = {}
_GUARD = threading.Lock()


def materialize(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/snapshots/{uuid.uuid4().hex}"
    _CREATED.append((spark, path))
    df.write.parquet(path, compression=COMPRESSION)
    return spark.read.schema(df.schema).parquet(path)


class SilverHistory(list):
    """Snapshots of a Silver table after each run (a list), the change rows of each run and the rows set aside."""

    def __init__(self, snapshots, table, rejected: StructType):
        super().__init__(snapshots)
        self.table, self.rejected = table, rejected

    def changed_rows(self, run_index: int) -> DataFrame:
        """Rows inserted or updated by run ``run_index`` (T4/T5): exactly what its commit wrote."""
        return self.table.changes(run_index)

    def quarantined(self) -> DataFrame:
        """The records that the runs set aside because their key has a NULL part, with their ``run``."""
        return self.table.spark.read.schema(self.rejected).parquet(quarantine_path(self.table))


class DimHistory(list):
    """A dimension after each SCD-2 run (a list), and the versions that each run opened."""

    def __init__(self, snapshots, table, current_col: str):
        super().__init__(snapshots)
        self.table, self.current_col = table, current_col

    @property
    def most(self) -> int | None:
        """The surrogate keys handed out so far: no snapshot has more rows."""
        return self.table.meta().get("sk_base")

    def opened(self, run_index: int) -> DataFrame:
        return self.table.changes(run_index).filter(F.col(self.current_col))


def new_table(spark: SparkSession, name: str, keys, root: str | None = None, bucketed: bool = False):
    """``bucketed``: a new table gets a bucket for each shuffle partition."""
    from stratum.sources.snapshots import ChangeTable
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions")) if bucketed else None
    if root is None:
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
        _CREATED.append((spark, root))
    return ChangeTable(spark, root, list(keys), buckets=buckets)


def quarantine_path(table) -> str:
    return f"{table.root}/quarantine"


def _complete(spark: SparkSession, path: str) -> bool:
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def silver_runs(spark: SparkSession, spec, batches: list[tuple[DataFrame, object]], name: str,
                root: str | None = None) -> SilverHistory:
    """Apply a Silver spec to successive batches; each run writes only the rows it inserts or updates.

    Version = run number - 1. The result holds the table as of each run (earlier versions stay readable, which
    the history reports use) and each run's change rows for Gold. Records whose key has a NULL part are written to the
    table's quarantine, one partition per run: what a run takes in, supersedes and sets aside is its whole batch. With
    ``root`` the table lives there: what it has already committed, of either, is not repeated.
    """
    table = new_table(spark, name, spec.keys, root, spec.bucketed)
    n = table.buckets

    def merge(version, raw, run_ts):
        last = table.last_commit()
        if last is None or version > last:
            table.merge(spec.prepare(raw, run_ts, keyed=True, partitions=n),
                        lambda target, src: spec.merge_prepared(target, src, run_ts, only_source=bool(n)),
                        changed=spec.changed_by(run_ts), version=version, whole=bool(n))

    def set_aside(version, raw, run_ts):
        path = f"{quarantine_path(table)}/run={version}"
        if not _complete(spark, path):
            spec.quarantine(raw, run_ts).write.mode("overwrite").parquet(path, compression=COMPRESSION)

    with ThreadPoolExecutor(max_workers=2) as pool:      # a run's two outputs do not depend on each other
        for version, (raw, run_ts) in enumerate(batches):
            beside = pool.submit(set_aside, version, raw, run_ts)
            merge(version, raw, run_ts)
            beside.result()
    rejected = StructType([*spec.quarantine(*batches[0]).schema.fields, StructField("run", IntegerType())])
    return SilverHistory([table.read(v) for v in range(len(batches))], table, rejected)


def scd2_runs(spark: SparkSession, spec, sources: list[tuple[DataFrame, object]], name: str,
              root: str | None = None) -> DimHistory:
    """SCD-2 runs on a dimension stored as its changes: a run writes the versions it closes and opens.

    Fed with change rows (T7), a run reads the current rows of their keys only. The largest surrogate key is
    part of each commit, so a later process goes on from there.
    """
    table = new_table(spark, name, [spec.sk_col], root)
    for version, (source, run_ts) in enumerate(sources):
        scd2_commit(table, source, spec, run_ts, version)
    return DimHistory([table.read(v) for v in range(len(sources))], table, spec.current_col)


def memo(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    with _GUARD:
        lock = _LOCKS.setdefault(key, threading.Lock())
    with lock:
        if key not in _MEMO:
            _MEMO[key] = build()
    return _MEMO[key]


def clear(delete_files: bool = False) -> None:
    """Forget memoised snapshots; with ``delete_files`` also vacuum the folders they were written to
    (only folders this process created, never anything else)."""
    _MEMO.clear()
    if delete_files:
        for spark, path in _CREATED:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        _CREATED.clear()
