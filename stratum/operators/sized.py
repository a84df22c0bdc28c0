"""Joins whose strategy follows known numbers of rows instead of the planner's estimate.

The planner takes the compressed bytes of a table's files, cut to the share of the columns that are read, for the size of its
rows. Keys of a compressed table are twenty and more times as large as that, and what it then broadcasts passes whole through
the driver. Here a side is broadcast only when the rows it can have at most fit ``spark.sql.autoBroadcastJoinThreshold``;
otherwise both sides are merged, whatever the estimate.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, DecimalType, MapType, StringType, StructType

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"
_UNITS = {"": 0, "b": 0, "k": 1, "m": 2, "g": 3, "t": 4, "p": 5}


def threshold(spark) -> int:
    """The session's broadcast threshold in bytes; negative: nothing is broadcast."""
    number, unit = re.fullmatch(r"(-?\d+)([a-z]?)b?", spark.conf.get(THRESHOLD).strip().lower()).groups()
    return int(number) * 1024 ** _UNITS[unit]


def row_bytes(schema: StructType) -> int:
    """Bytes of a row in memory: eight for each column, and what lies outside of them."""
    def beside(kind: DataType) -> int:
        if isinstance(kind, (StringType, BinaryType)):
            return 32
        if isinstance(kind, DecimalType):
            return 16 if kind.precision > 18 else 0
        return 64 if isinstance(kind, (ArrayType, MapType, StructType)) else 0
    return 8 + sum(8 + beside(f.dataType) for f in schema.fields)


def fits(df: DataFrame, most: int | None) -> bool:
    """Whether ``df``, of at most ``most`` rows (None: not known), may be broadcast."""
    return most is not None and most * row_bytes(df.schema) <= threshold(df.sparkSession)


def sized(df: DataFrame, most: int | None = None) -> DataFrame:
    """``df`` as the right side of an equi-join: broadcast when it fits, else merged."""
    return F.broadcast(df) if fits(df, most) else df.hint("merge")


def look_up(rows: DataFrame, keys: Sequence[str], dims: Sequence[tuple[str, DataFrame, int | None]]) -> DataFrame:
    """``rows`` (one for each of ``keys``, no part NULL) left-joined with each of ``dims``: (column, dimension, its most rows).
    A dimension that fits is broadcast. To the others only keys and columns are shuffled, and back to ``keys``: rows that lie
    by their keys meet the outcome where they are."""
    large = [(column, dim) for column, dim, most in dims if not fits(dim, most)]
    out = rows
    for column, dim, most in dims:
        if fits(dim, most):
            out = out.join(F.broadcast(dim), column, "left")
    if large:
        found = rows.select(*dict.fromkeys([*keys, *[column for column, _ in large]]))
        for column, dim in large:
            found = found.join(dim.hint("merge"), column, "left")
        found = found.drop(*[column for column, _ in large if column not in keys])
        out = out.join(found.hint("merge"), list(keys), "left")
    return out
