"""The date dimension (a day spine with calendar attributes)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratum.functions.temporal import date_parts

# Fixed values of the reference's date dimension: 3,650 consecutive days.
DATE_DIM_DAYS = 3650


def date_dimension(spark: SparkSession, start: str | Column, days: int = DATE_DIM_DAYS) -> DataFrame:
    """``days`` consecutive dates from ``start`` (a 'yyyy-MM-dd' string or a DATE column literal).

    The spine is ``spark.range`` (split across tasks), the attributes are F12 expressions.
    """
    start_col = F.lit(start).cast("date") if isinstance(start, str) else start
    spine = spark.range(0, days).select(F.date_add(start_col, F.col("id").cast("int")).alias("date_id"))
    return spine.select("date_id", *[e.alias(n) for n, e in date_parts(F.col("date_id")).items()])
