"""Keep the latest row per key (``QUALIFY ROW_NUMBER() OVER (...) = 1``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _order(c: str | Column) -> Column:
    return F.col(c).desc_nulls_last() if isinstance(c, str) else c


def dedup_latest(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str | Column],
                 tie_break: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key: the first by ``order_by`` (column names mean DESC NULLS LAST).

    ``tie_break`` appends a total order so the survivor is reproducible (the reference leaves
    ties arbitrary). Catalyst plans ``row_number() = 1`` as a WindowGroupLimit on both sides of
    the shuffle, so each map task forwards at most one row per key: a hot key costs no more
    shuffle than a cold one.
    """
    w = Window.partitionBy(*keys).orderBy(*[_order(c) for c in list(order_by) + list(tie_break)])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
