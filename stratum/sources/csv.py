"""CSV scan, schema inference, header normalisation, load by column name, bad-row quarantine."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Header row, optional double-quote enclosure, doubled quotes inside a quoted value.
# Blank lines are skipped by the reader. A quoted "" stays '' while an empty field is NULL: the
# reader already returns NULL for an empty unquoted field, so nullValue is set to a marker that
# never occurs (with nullValue='' a quoted "" would turn into NULL as well).
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "\u0000",
               "mode": "PERMISSIVE", "multiLine": "true"}   # multiLine: quoted cells may hold line breaks
CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | None = None,
             infer: bool = False) -> DataFrame:
    """CSV files by their own headers. With ``schema``, columns are matched by name (S3), whatever their order in
    each file; a value that does not fit its type becomes NULL (use :func:`load_files` to keep such rows)."""
    if schema is None:
        reader = spark.read.options(**CSV_OPTIONS)
        return (reader.option("inferSchema", "true") if infer else reader).csv(path)
    frames = [load_by_name(extract.read(spark.read.options(**CSV_OPTIONS).schema(_string_schema(extract.names, corrupt=False))),
                           schema) for extract in header_groups(spark, path)]
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)


@dataclass(frozen=True)
class Extract:
    """The files of one load that share a header: where they lie, and which of them where others lie there too."""
    names: list[str]
    path: str | list[str]
    only: DataFrame | None = None      # (header_file)

    def read(self, reader) -> DataFrame:
        """The files' rows, with ``FILE`` where it has to be known."""
        rows = reader.csv(self.path)
        if self.only is None:
            return rows
        return rows.withColumn(FILE, F.col("_metadata.file_path")).join(self.only, F.col(FILE) == F.col("header_file"), "left_semi").drop(FILE)


FILE = "__file"


def header_groups(spark: SparkSession, path: str | list[str]) -> list[Extract]:
    """The files at ``path`` by their header, that is by their first line; empty files are left out.

    Only the distinct header lines reach the driver. Where there are several, the files of each are told apart on the
    executors; the names that the caller lists in ``path`` (a stream's micro-batch) are sorted out here instead."""
    lines = (spark.read.text(path).select("value", F.col("_metadata.file_path").alias("header_file"),
                                          F.col("_metadata.file_block_start").alias("at"),
                                          F.monotonically_increasing_id().alias("n"))
             .filter("at = 0").groupBy("header_file").agg(F.min_by("value", "n").alias("header"))
             .withColumn("header", F.regexp_replace("header", "^\ufeff|\r$", "")))
    listed: dict[str, list[str]] = {}
    if isinstance(path, list):
        for r in lines.collect():              # at most as many rows as the caller has named files or folders of one load
            listed.setdefault(r["header"], []).append(unquote(r["header_file"]))
        headers = sorted(listed)
    else:
        headers = sorted(r["header"] for r in lines.select("header").distinct().collect())      # one row per layout
    out = []
    for header in headers:
        names = next(csv.reader([header]), [])
        seen = [normalize_name(n) or f"column_{k}" for k, n in enumerate(names)]
        names = [n if n.strip() and seen.count(normalize_name(n)) == 1 else f"{n.strip() or 'column'} {k}"
                 for k, n in enumerate(names)]
        if names and isinstance(path, list):
            out.append(Extract(names, sorted(listed[header])))
        elif names:
            own = None if len(headers) == 1 else lines.filter(F.col("header") == header).select("header_file")
            out.append(Extract(names, path, own))
    return out


def infer_schema(spark: SparkSession, path: str | list[str]) -> StructType:
    """Infer once (header names + sampled types); persist ``schema.json()`` as the table contract."""
    return read_csv(spark, path, infer=True).schema


def normalize_name(name: str) -> str:
    """``"First Name"`` / ``FIRST_NAME`` / ``first-name`` -> ``first_name``."""
    return re.sub(r"[^0-9A-Za-z]+", "_", name.strip()).strip("_").lower()


def normalize_names(df: DataFrame) -> DataFrame:
    names = [normalize_name(c) for c in df.columns]
    dup = {n for n in names if names.count(n) > 1}
    if dup:
        raise ValueError(f"column names collide after normalisation: {sorted(dup)}")
    return df.toDF(*names)


def load_by_name(df: DataFrame, target: StructType) -> DataFrame:
    """S3 ``MATCH_BY_COLUMN_NAME = CASE_INSENSITIVE``: match by normalised name, try-cast to the
    target type, drop columns the target lacks, add missing ones as typed NULLs."""
    by_norm = {normalize_name(c): c for c in df.columns}
    cols = []
    for f in target.fields:
        src = by_norm.get(normalize_name(f.name))
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            c = F.col(f"`{src}`")
            cols.append((c if df.schema[src].dataType == f.dataType else c.try_cast(f.dataType)).alias(f.name))
    return df.select(*cols)


def _string_schema(names: Iterable[str], corrupt: bool = True) -> StructType:
    return StructType([StructField(n, StringType()) for n in names] + [StructField(CORRUPT, StringType())] * corrupt)


def load_csv_with_quarantine(spark: SparkSession, path: str | list[str], target: StructType,
                             header: list[str], has_header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S5 ``ON_ERROR = CONTINUE``: returns (good rows typed as ``target``, quarantined raw rows).

    The file is read as text columns named by ``header`` (the file's own header order); a row is
    bad when the reader marks it corrupt (too many / too few fields) or when a non-empty value
    does not cast to its target type. Nothing is dropped silently: good + bad = input.
    """
    raw = spark.read.options(**CSV_OPTIONS).option("header", str(has_header).lower()) \
        .option("columnNameOfCorruptRecord", CORRUPT).schema(_string_schema(header)).csv(path)
    by_norm = {normalize_name(c): c for c in header}
    bad_cast = F.lit(False)
    for f in target.fields:
        src = by_norm.get(normalize_name(f.name))
        if src is not None and not isinstance(f.dataType, StringType):
            v = F.col(f"`{src}`")
            bad_cast = bad_cast | (v.isNotNull() & v.try_cast(f.dataType).isNull())
    # The reader only checks the field count of a row when every column is parsed; with CSV column
    # pruning a query needing a few columns would never mark short/long rows. Referencing all
    # file columns in the flag keeps them in the scan (the length test itself is always false).
    parsed_all = F.length(F.concat_ws("\u0001", *[F.col(f"`{c}`") for c in header])) < 0
    flagged = raw.withColumn("__bad", F.col(CORRUPT).isNotNull() | bad_cast | parsed_all)
    good = load_by_name(flagged.filter(~F.col("__bad")).drop(CORRUPT, "__bad"), target)
    bad = flagged.filter(F.col("__bad")).drop("__bad")
    return good, bad


def load_files(spark: SparkSession, path: str | list[str], target: StructType, keys: Iterable[str] = (),
               source_file_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows typed as ``target``, bad rows) of CSV files with their own headers, matched by name.

    A row is bad if it has too few or too many fields, a value that does not cast, or a NULL among ``keys``. Bad rows
    come as (source_file, reason, record): the record is a JSON object of the file's own columns. good + bad = input."""
    lineage = [StructField(source_file_col, StringType())] if source_file_col else []
    good = [spark.createDataFrame([], StructType([*target.fields, *lineage]))]
    bad = [spark.createDataFrame([], "source_file string, reason string, record string")]
    for extract in header_groups(spark, path):
        names = extract.names
        raw = (spark.read.options(**CSV_OPTIONS).option("columnNameOfCorruptRecord", CORRUPT)
               .schema(_string_schema(names)).csv(extract.path))
        by_norm = {normalize_name(c): c for c in names}
        reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("fields"))
        for f in target.fields:
            src = by_norm.get(normalize_name(f.name))
            if src is not None and not isinstance(f.dataType, StringType):
                v = F.col(f"`{src}`")
                reason = reason.when(v.isNotNull() & v.try_cast(f.dataType).isNull(), F.lit(f"type of {f.name}"))
        for k in keys:
            src = by_norm.get(normalize_name(k))
            reason = reason.when(F.col(f"`{src}`").isNull() if src else F.lit(True), F.lit(f"no {k}"))
        record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in names], F.col(CORRUPT)))
        # the record is part of every row, so the reader parses all columns and counts the fields of each row
        read = raw.select("*", record.alias("__record"), F.col("_metadata.file_path").alias(FILE),
                          reason.alias("__reason")).filter(F.length("__record") >= 0)
        if extract.only is not None:
            read = read.join(extract.only, F.col(FILE) == F.col("header_file"), "left_semi")
        fit = read.filter("__reason IS NULL").withColumnRenamed("__file", source_file_col or "__file")
        good.append(load_by_name(fit.select(*[f"`{c}`" for c in names], *[f.name for f in lineage]),
                                 StructType([*target.fields, *lineage])))
        bad.append(read.filter("__reason IS NOT NULL").select(F.col("__file").alias("source_file"),
                                                              F.col("__reason").alias("reason"), F.col("__record").alias("record")))
    return reduce(DataFrame.unionByName, good), reduce(DataFrame.unionByName, bad)


def load_extract(spark: SparkSession, path: str | list[str], target: StructType, bronze, batch_name: str,
                 quarantine=None, keys: Iterable[str] = ()) -> None:
    """One Bronze load of a landing extract: match columns by each file's header, type them, append the good rows
    to ``bronze`` and the bad ones to ``quarantine`` (both :class:`stratum.sources.snapshots.SnapshotTable`)
    under the batch's own name; loading the same ``batch_name`` again is a no-op. The bad rows are written first, so no
    committed load leaves any behind. Without ``quarantine`` a bad row is an error."""
    good, bad = load_files(spark, path, target, keys)
    if quarantine is not None:
        quarantine.append(bad, batch_name)
    elif not bad.isEmpty():
        raise ValueError(f"{batch_name} has rows that do not fit the table, and there is no quarantine")
    bronze.append(good, batch_name)
