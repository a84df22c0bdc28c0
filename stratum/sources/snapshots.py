"""S6/S9 table state: append-only Bronze and versioned, atomically published snapshots.

There is no row-level MERGE on plain parquet, so a Silver/Gold table is a series of immutable
versions ``<root>/v=<n>/``. A version is visible once its ``_SUCCESS`` marker exists (written by
Spark's commit protocol after every task committed). Readers pick the highest complete version,
so nobody ever sees a half-built table (the reference's TRUNCATE + INSERT does expose one), and
re-running a batch that already committed its version is a no-op (idempotent replay).
File listing goes through the Hadoop FileSystem of the path, so it works on any shared store.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.operators.sized import sized
from stratum.session import COMPRESSION
from stratum.sources.bucketed import attach, write_bucketed


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _committed(self) -> list[int]:
        root = self._Path(self.root)
        if not self._fs.exists(root):
            return []
        out = []
        for st in self._fs.listStatus(root):
            name = st.getPath().getName()
            if name.startswith("v=") and name[2:].isdigit() and \
                    self._fs.exists(self._Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[2:]))
        return sorted(out)

    def current_version(self) -> int | None:
        v = self._committed()
        return v[-1] if v else None

    def path(self, version: int) -> str:
        return f"{self.root}/v={version}"

    def read(self, version: int | None = None) -> DataFrame | None:
        v = self.current_version() if version is None else version
        return None if v is None else self.spark.read.parquet(self.path(v))

    def publish(self, df: DataFrame, version: int | None = None) -> int:
        """Write ``df`` as version ``version`` (default: next). Already committed -> skipped."""
        if version is None:
            cur = self.current_version()
            version = 0 if cur is None else cur + 1
        if version in self._committed():
            return version
        df.write.mode("overwrite").parquet(self.path(version), compression=COMPRESSION)
        return version

    def append(self, df: DataFrame, batch_name: str) -> None:
        """S6 Bronze append: each batch lands under its own name, so a replay cannot double-load."""
        target = f"{self.root}/batch={batch_name}"
        if self._fs.exists(self._Path(target, "_SUCCESS")):
            return
        df.write.mode("overwrite").parquet(target, compression=COMPRESSION)


class ChangeTable:
    """Keyed table stored as its changes: a commit writes only the rows that it inserts or replaces.

    Layout: ``<root>/v=<version>/`` the rows of a commit, ``<root>/base=<version>/`` a compacted whole table, and
    ``<root>/_commits/<version>.json`` the manifest of a commit: which base and which changes make up the table,
    how many rows a change has (unless bucketed), and the caller's ``meta`` (such as the last surrogate key). Data are written
    to their final place and never moved; a version exists once its manifest does, so a crash before that leaves it invisible and running it again
    overwrites what was left. The latest row of a key wins. After ``max_changes`` commits the next one also writes a
    new base, so a read merges a bounded number of changes.

    With ``buckets`` every part is bucketed by the keys (Spark's own bucketing; the number is part of the manifest, the first
    commit's holds): a batch dealt to as many partitions by the keys meets the table, and the parts meet one another, without
    shuffling the table.

    One writer per table (the pipeline run or the stream's ``foreachBatch``); readers are unlimited.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], max_changes: int = 8, buckets: int | None = None):
        self.spark, self.root, self.keys, self.max_changes = spark, root.rstrip("/"), list(keys), max_changes
        self._buckets = buckets
        self._jvm = spark.sparkContext._jvm
        self._Path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        p = self._Path(f"{self.root}/_commits")
        if not self._fs.exists(p):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(p)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def last_commit(self) -> int | None:
        versions = self._versions()
        return versions[-1] if versions else None

    def manifest(self, as_of: int | None = None) -> dict | None:
        versions = [v for v in self._versions() if as_of is None or v <= as_of]
        if not versions:
            return None
        stream = self._fs.open(self._Path(f"{self.root}/_commits/{versions[-1]}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    @property
    def buckets(self) -> int | None:
        m = self.manifest()
        return m.get("buckets") if m else self._buckets

    def _catalog_name(self, path: str) -> str:
        return "stratum_" + hashlib.md5(path.encode()).hexdigest()

    def dealt(self, parts: list[DataFrame]) -> DataFrame:
        """The union of ``parts``, each dealt to the buckets by itself: those that lie so already are not shuffled."""
        n = self.buckets
        return reduce(DataFrame.unionByName, [p.repartition(n, *self.keys) if n else p for p in parts])

    def _write_part(self, rows: DataFrame, path: str, buckets: int | None, dealt: bool = False) -> None:
        if buckets:
            write_bucketed(rows, self._catalog_name(path), path, self.keys, buckets, dealt)
        else:
            rows.write.mode("overwrite").parquet(path, compression=COMPRESSION)

    def _part(self, path: str, schema: StructType, buckets: int | None) -> DataFrame:
        if buckets:
            return attach(self.spark, self._catalog_name(path), path, schema, self.keys, buckets)
        return self.spark.read.schema(schema).parquet(path)

    def meta(self) -> dict:
        m = self.manifest()
        return m["meta"] if m else {}

    def _write_manifest(self, version: int, manifest: dict) -> None:
        final = self._Path(f"{self.root}/_commits/{version}.json")
        temp = self._Path(f"{self.root}/_commits/_{version}.{uuid.uuid4().hex}")
        out = self._fs.create(temp)
        out.write(json.dumps(manifest).encode("utf-8"))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(temp, final):
            self._fs.delete(temp, False)
            raise RuntimeError(f"version {version} of {self.root} could not be committed")

    def read(self, as_of: int | None = None) -> DataFrame | None:
        """The table as of the last commit, or as of version ``as_of``; None before the first commit."""
        return self._assemble(self.manifest(as_of))

    def read_for(self, rows: DataFrame, on: list[str] | None = None, as_of: int | None = None,
                 most: int | None = None) -> DataFrame | None:
        """The table's rows that match ``rows`` on ``on`` (default: the keys; else columns that a key's row never changes).
        Each stored part is cut down to them before parts meet, so nothing else is shuffled or sorted. ``most``: how many
        ``rows`` there are at most, if that is known; few are broadcast."""
        return self._assemble(self.manifest(as_of), rows.select(*(on or self.keys)), on, most)

    def _assemble(self, m: dict | None, only: DataFrame | None = None, on: list[str] | None = None,
                  most: int | None = None) -> DataFrame | None:
        if m is None:
            return None
        parts = [(-1, f"{self.root}/base={m['base']}")] if m["base"] is not None else []
        parts += [(v, f"{self.root}/v={v}") for v in m["changes"]]
        schema = StructType.fromJson(m["schema"])      # known: no job to read it from the files
        frames = [self._part(path, schema, m.get("buckets")).withColumn("__v", F.lit(v)) for v, path in parts]
        there = bool(m.get("buckets"))      # parts in buckets meet by the keys where they lie, and never pass through the driver
        if only is not None:
            only = only.hint("merge") if there and not on else sized(only, most)
            frames = [f.join(only, list(on or self.keys), "left_semi") for f in frames]
        oldest, newer = frames[0], frames[1:]
        if not newer:
            return oldest.drop("__v")
        rows = reduce(DataFrame.unionByName, newer)
        if len(newer) > 1:
            latest = Window.partitionBy(*self.keys).orderBy(F.col("__v").desc())
            rows = rows.withColumn("__n", F.row_number().over(latest)).filter("__n = 1").drop("__n")
        # the oldest part is most of the table: beside a few changes it is neither sorted nor shuffled
        counts = [m.get("rows", {}).get(str(v)) for v, _ in parts[1:]]
        replaced = sized(rows.select(*self.keys), None if there or None in counts else sum(counts))
        return oldest.join(replaced, self.keys, "left_anti").unionByName(rows).drop("__v")

    def changes(self, version: int) -> DataFrame | None:
        """The rows that commit ``version`` inserted or replaced."""
        if version not in self._versions():
            return None
        m = self.manifest(version)
        return self._part(f"{self.root}/v={version}", StructType.fromJson(m["schema"]), m.get("buckets"))

    def commit(self, rows: DataFrame, version: int | None = None, meta: dict | None = None, dealt: bool = False) -> int:
        """Write ``rows`` (inserted or replacing the row of the same key) as ``version``; a version that is
        already committed is left alone (replay). ``dealt``: ``rows`` come from :meth:`dealt`."""
        last = self.last_commit()
        version = (0 if last is None else last + 1) if version is None else version
        if last is not None and version <= last:
            return version
        had = self.manifest() or {"base": None, "changes": [], "meta": {}, "buckets": self._buckets}
        buckets = had.get("buckets")
        self._write_part(rows, f"{self.root}/v={version}", buckets, dealt)
        new = {"base": had["base"], "changes": [*had["changes"], version], "meta": {**had["meta"], **(meta or {})},
               "schema": json.loads(rows.schema.json()), "buckets": buckets, "rows": had.get("rows", {})}
        if not buckets:       # from the files' footers: what a reader may broadcast
            new["rows"] = {**new["rows"], str(version): self._part(f"{self.root}/v={version}", rows.schema, None).count()}
        if len(new["changes"]) > self.max_changes:
            self._write_part(self._assemble(new), f"{self.root}/base={version}", buckets)
            new |= {"base": version, "changes": [], "rows": {}}
        self._write_manifest(version, new)
        return version

    def merge(self, source: DataFrame, merge_fn, changed: Column, version: int | None = None, whole: bool = False) -> int:
        """``merge_fn(rows of the table with keys of source or None, source)`` gives those keys' new rows; only
        those with ``changed`` are written. ``source`` has at most one row per key. ``whole``: ``merge_fn`` is handed the
        whole table and itself gives rows of the source's keys only (a bucketed table need not be cut down first)."""
        last = self.last_commit()
        if version is not None and last is not None and version <= last:
            return version
        if last is None:
            return self.commit(merge_fn(None, source), version)
        if whole:
            table = self.read()
            table = table.select(*self.keys, *[c for c in table.columns if c not in self.keys])   # as read_for has them
            return self.commit(merge_fn(table, source).filter(F.coalesce(changed, F.lit(False))), version)
        # the batch is read twice (its keys, then its rows): computed once
        source = source.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return self.commit(merge_fn(self.read_for(source, most=source.count()), source).filter(F.coalesce(changed, F.lit(False))), version)
        finally:
            source.unpersist()

    def expire(self, keep: int = 2) -> int:
        """Delete manifests before the last ``keep`` and the data no kept manifest names; returns how many folders."""
        versions = self._versions()
        old, kept = versions[:-keep], versions[-keep:]
        wanted = set()
        for v in kept:
            m = self.manifest(v)
            wanted |= {f"v={c}" for c in [*m["changes"], v]} | {f"base={m['base']}"}
        for v in old:
            self._fs.delete(self._Path(f"{self.root}/_commits/{v}.json"), False)
        gone = 0
        for st in self._fs.listStatus(self._Path(self.root)):
            name = st.getPath().getName()
            kind, _, number = name.partition("=")
            if kind in ("v", "base") and name not in wanted and versions and int(number) <= versions[-1]:
                gone += bool(self._fs.delete(st.getPath(), True))
        return gone
