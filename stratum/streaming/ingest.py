"""T1-T8 on Structured Streaming.

* T1 ``stream_ingest``: new landing files -> Bronze parquet (append), ``availableNow`` trigger, so each
  scheduled run processes exactly what arrived since the last one. Files must land under unique
  names: the file source never re-reads a name it has seen, even if the file is overwritten.
* T2 consume-once: the checkpoint's offset log is the stream position; existing files are read on
  the first run (``SHOW_INITIAL_ROWS``), later runs only see new ones.
* T3 ``stream_merge``: Bronze stream -> ``foreachBatch`` -> SCD-1 merge into a versioned snapshot
  table. The version number is the micro-batch id, so a batch replayed after a failure finds its
  version already committed and does nothing (idempotent, exactly-once effect).
* T6 ``has_new_files``: the gate; ``availableNow`` itself runs zero batches when nothing is new.
* T7 ``stream_changes``: the change folders of a Silver table as a stream into an SCD-2 dimension.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stratum.operators.scd2 import scd2_commit
from stratum.sources.csv import load_files
from stratum.sources.snapshots import SnapshotTable


def land_batch(df: DataFrame, landing_dir: str, batch_name: str, fmt: str = "parquet") -> str:
    """Write one extract under its own, never reused name (what an uploader should do)."""
    path = f"{landing_dir.rstrip('/')}/{batch_name}"
    df.write.mode("errorifexists").format(fmt).option("header", "true").save(path)
    return path


FILE_LOG = "_files"      # under the checkpoint: one row per file that a run has loaded
BATCH = "ingest_batch"   # Bronze folder of a micro-batch


def stream_ingest(spark: SparkSession, landing_dir: str, bronze_dir: str, schema: StructType, checkpoint: str,
                  quarantine_dir: str | None = None, keys: tuple[str, ...] = (), clean_source: str | None = None,
                  archive_dir: str | None = None, source_file_col: str | None = None,
                  max_files: int = 1000) -> StreamingQuery:
    """One ``availableNow`` run of landing CSV files -> Bronze, in micro-batches of at most ``max_files`` files.

    Each file's columns are matched by its own header; rows that do not fit, or lack one of ``keys``, go to
    ``quarantine_dir`` (default: beside Bronze) before anything is cleaned. A micro-batch overwrites its own folders, so a
    replay after a failure adds nothing twice; its files are logged, also those without rows.
    ``clean_source='delete'|'archive'`` removes (S8) only the files this query has committed, never files that
    arrived afterwards. ``source_file_col`` adds the landing file of each row (Bronze lineage)."""
    bronze_dir, checkpoint = bronze_dir.rstrip("/"), checkpoint.rstrip("/")
    quarantine_dir = (quarantine_dir or bronze_dir + "_quarantine").rstrip("/")
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", max_files)
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    arrived = reader.load(f"{landing_dir.rstrip('/')}/*").select(F.col("_metadata.file_path").alias("file"))

    def load(batch: DataFrame, batch_id: int) -> None:
        files = [r["file"] for r in batch.distinct().collect()]     # at most max_files names
        good, bad = load_files(spark, [unquote(f) for f in files], schema, keys, source_file_col) if files else (None, None)
        if files:
            bad.write.mode("overwrite").parquet(f"{quarantine_dir}/{BATCH}={batch_id}")
            good.write.mode("overwrite").parquet(f"{bronze_dir}/{BATCH}={batch_id}")
        (spark.createDataFrame([(f, batch_id) for f in files], "file string, batch long")
         .write.mode("overwrite").parquet(f"{checkpoint}/{FILE_LOG}/{BATCH}={batch_id}"))

    return (arrived.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_bronze(spark: SparkSession, bronze_dir: str) -> DataFrame:
    """All rows that ``stream_ingest`` has put there (or into its quarantine)."""
    return spark.read.parquet(bronze_dir).drop(BATCH)


class MergeSink:
    """``foreachBatch`` target: merge each micro-batch into a :class:`SnapshotTable` as version ``batch_id``."""

    def __init__(self, table: SnapshotTable, merge: Callable[[DataFrame | None, DataFrame, Column], DataFrame],
                 run_ts_for: Callable[[int], Column]):
        self.table, self.merge, self.run_ts_for = table, merge, run_ts_for

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.table.current_version() is not None and self.table.current_version() >= batch_id:
            return  # replay of a committed batch
        prev = self.table.read()
        self.table.publish(self.merge(prev, batch, self.run_ts_for(batch_id)), version=batch_id)


class TableMergeSink:
    """``foreachBatch`` target for a :class:`ChangeTable`: a micro-batch writes the rows it changes, as version
    ``batch_id`` (a replayed batch id is a no-op)."""

    def __init__(self, table, spec, run_ts_for: Callable[[int], Column]):
        self.table, self.spec, self.run_ts_for = table, spec, run_ts_for

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        ts = self.run_ts_for(batch_id)
        self.table.merge(self.spec.prepare(batch, ts), lambda target, src: self.spec.merge_prepared(target, src, ts),
                         changed=self.spec.changed_by(ts), version=batch_id)


class DimensionSink:
    """``foreachBatch`` target of :func:`stream_changes`: each Silver run in a micro-batch is one SCD-2 run on the stored
    dimension, joined with the stored current versions of its keys. A Silver run that is committed, in a replayed
    micro-batch or another one, is left alone."""

    def __init__(self, table, spec, source: Callable[[DataFrame], DataFrame], run_ts_for: Callable[[int], Column]):
        self.table, self.spec, self.source, self.run_ts_for = table, spec, source, run_ts_for

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        runs = sorted(r[RUN] for r in batch.select(RUN).distinct().collect())     # one number per waiting Silver run
        for run in runs:
            rows = batch.filter(F.col(RUN) == run).drop(RUN)
            scd2_commit(self.table, self.source(rows), self.spec, self.run_ts_for(run), run)


RUN = "__run"


def stream_changes(spark: SparkSession, silver_root: str, schema: StructType, sink: Callable[[DataFrame, int], None],
                   checkpoint: str) -> StreamingQuery:
    """One ``availableNow`` run of a Silver table's change folders (one per Silver run) into ``sink``. The checkpoint is
    the position, so each change row is read once; it has to start after the Silver run has committed, as a scheduled
    graph does."""
    stream = (spark.readStream.schema(schema).parquet(f"{silver_root.rstrip('/')}/v=*")
              .withColumn(RUN, F.regexp_extract(F.col("_metadata.file_path"), "/v=([0-9]+)/", 1).cast("int")))
    return (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_merge(spark: SparkSession, bronze_dir: str, schema: StructType, sink: MergeSink,
                 checkpoint: str) -> StreamingQuery:
    """One ``availableNow`` run of Bronze -> Silver."""
    stream = spark.readStream.schema(schema).parquet(f"{bronze_dir.rstrip('/')}/*")
    return (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def pending_files(spark: SparkSession, landing_glob: str, checkpoint: str) -> DataFrame:
    """Landing files (column ``file``) that no run of the ingest with this ``checkpoint`` has loaded: the listing
    anti-joined with the file log. No file content and no Bronze row is read."""
    files = spark.read.format("binaryFile").load(landing_glob).select(F.col("_metadata.file_path").alias("file"))
    log = f"{checkpoint.rstrip('/')}/{FILE_LOG}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(log)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return files
    return files.join(spark.read.parquet(log).select("file"), "file", "left_anti")


def pending_rows(spark: SparkSession, landing_glob: str, checkpoint: str, schema: StructType) -> DataFrame:
    """The rows of all files that still wait on the stage, however many; which files they are stays on the executors."""
    rows = load_files(spark, landing_glob, schema, source_file_col="__landed")[0]
    files = pending_files(spark, landing_glob, checkpoint)
    return rows.join(files, rows["__landed"] == files["file"], "left_semi").drop("__landed")


def has_new_files(spark: SparkSession, landing_glob: str, checkpoint: str) -> bool:
    """T6 gate: is anything on the stage that the ingest has not loaded yet?"""
    return not pending_files(spark, landing_glob, checkpoint).isEmpty()
