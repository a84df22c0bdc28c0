"""S2 for a whole stage: the contracts of all its tables from one aggregate, kept and widened by later extracts.

A stage holds one folder of CSV extracts per table, each file with its own header. Every cell becomes a row (table, column,
value), and what is known of a column is a small state that merges by AND: whether all its values so far fit each type. The
state of many files, tables and deliveries is one partial aggregate; a later file can only widen a type, never narrow it.
"""

from __future__ import annotations

import csv
import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DoubleType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from stratum.sources.csv import CSV_OPTIONS, normalize_name

# Narrowest first: a column has the first type that all its values fit; text fits everything.
TYPES: list[tuple[str, DataType]] = [("boolean", BooleanType()), ("long", LongType()), ("double", DoubleType()),
                                     ("date", DateType()), ("timestamp", TimestampNTZType())]
DATE = r"^\d{4}-\d{2}-\d{2}$"
# What every text that casts to a number or a timestamp looks like. A failed cast costs an exception per cell, so it is tried on
# these alone; text that looks so and is none still fails its cast.
_PAD = r"[\x00-\x20\x7F]*"
LIKE = {"long": rf"^{_PAD}[+-]?[0-9]+{_PAD}$",
        "double": rf"(?s)^{_PAD}[+-]?(?:[0-9.]+(?:[eE][+-]?[0-9]+)?[fFdD]?|0[xX].*|(?i:inf|nan).*){_PAD}$",
        "timestamp": rf"(?s)^{_PAD}[+-]?[0-9]{{4,7}}(?:-.*)?{_PAD}$"}


def _fits(name: str, kind: DataType, v: Column) -> Column:
    if name == "boolean":
        return F.lower(v).isin("true", "false")
    if name == "date":      # a timestamp casts to a date as well, and loses its time
        return v.rlike(DATE) & v.try_cast(kind).isNotNull()
    return v.rlike(LIKE[name]) & v.try_cast(kind).isNotNull()


def _first_lines(spark: SparkSession, stage: str) -> DataFrame:
    return (spark.read.text(f"{stage}/*/*").select("value", F.col("_metadata.file_path").alias("file"),
                                                   F.col("_metadata.file_block_start").alias("at"),
                                                   F.monotonically_increasing_id().alias("n"))
            .filter("at = 0").groupBy("file").agg(F.min_by("value", "n").alias("header")))


def column_states(spark: SparkSession, stage: str) -> DataFrame:
    """(table_name, column_name, position, n_values, boolean, long, double, date, timestamp) of every column of every table
    folder under ``stage``. Columns are matched by normalised header, so files may order them as they like."""
    stage = stage.rstrip("/")
    headers = [r["header"] for r in _first_lines(spark, stage).select("header").distinct().collect()]     # one per layout
    width = max([len(next(csv.reader([h]), [])) for h in headers], default=0)
    if not width:
        return spark.createDataFrame([], STATE)
    cells = [f"c{k}" for k in range(width)]
    options = {**CSV_OPTIONS, "header": "false"}
    rows = (spark.read.options(**options).schema(StructType([StructField(c, StringType()) for c in cells])).csv(f"{stage}/*/*")
            .select(F.array(*cells).alias("cells"), F.col("_metadata.file_path").alias("file"),
                    F.monotonically_increasing_id().alias("n")))      # a file is read by one task, from its start
    heads = rows.groupBy("file").agg(F.min("n").alias("head"))
    # names are worked out once per file, not per cell; there is one row per file, so the cells stay where they were read
    first = (rows.join(F.broadcast(heads), "file").filter(F.col("n") == F.col("head"))
             .select("file", "head", F.regexp_extract("file", "([^/]+)/[^/]+$", 1).alias("table_name"),
                     F.transform("cells", _column_name).alias("names")))
    body = rows.join(F.broadcast(first), "file").filter(F.col("n") > F.col("head"))
    cell = body.select("table_name", F.posexplode(F.arrays_zip("names", "cells")).alias("position", "x"))
    named = cell.filter("x.names IS NOT NULL").select("table_name", F.col("x.names").alias("column_name"), "position",
                                                      F.col("x.cells").alias("value"))
    known = F.col("value").isNotNull() & (F.trim("value") != "")
    fits = [F.coalesce(F.bool_and(F.when(known, _fits(name, kind, F.trim("value")))), F.lit(True)).alias(name) for name, kind in TYPES]
    return (named.groupBy("table_name", "column_name").agg(F.min("position").alias("position"), F.count_if(known).alias("n_values"), *fits)
            .select(*STATE.fieldNames()))


def _column_name(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_replace(F.trim(c), "[^0-9A-Za-z]+", "_")), "^_+|_+$", "")


STATE = StructType([StructField("table_name", StringType()), StructField("column_name", StringType()), StructField("position", LongType()),
                    StructField("n_values", LongType()), *[StructField(name, BooleanType()) for name, _ in TYPES]])


def merged_states(*states: DataFrame) -> DataFrame:
    """What all the extracts together say: counts add up, types widen."""
    every = states[0].select(*STATE.fieldNames())
    for s in states[1:]:
        every = every.unionByName(s.select(*STATE.fieldNames()))
    return every.groupBy("table_name", "column_name").agg(
        F.min("position").alias("position"), F.sum("n_values").alias("n_values"),
        *[F.bool_and(name).alias(name) for name, _ in TYPES])


def type_name() -> Column:
    """The type of a state: the narrowest that fits, text where nothing is known."""
    out = F.when(F.col("n_values") == 0, F.lit("string"))
    for name, _ in TYPES:
        out = out.when(F.col(name), F.lit(name))
    return out.otherwise(F.lit("string"))


def contracts(states: DataFrame) -> dict[str, StructType]:
    """The contract of every table; ``schema.json()`` is what is kept beside Bronze. One row per column reaches the driver."""
    kinds = {**dict(TYPES), "string": StringType()}
    out: dict[str, list[StructField]] = {}
    for r in states.select("table_name", "column_name", "position", type_name().alias("kind")).orderBy("table_name", "position").collect():
        out.setdefault(r["table_name"], []).append(StructField(normalize_name(r["column_name"]), kinds[r["kind"]]))
    return {t: StructType(fields) for t, fields in out.items()}


def to_json(found: dict[str, StructType]) -> str:
    return json.dumps({t: json.loads(s.json()) for t, s in sorted(found.items())})


def from_json(text: str) -> dict[str, StructType]:
    return {t: StructType.fromJson(s) for t, s in json.loads(text).items()}
