"""F3 lenient timestamp parsing, F4 text casts, F12 date parts, F13 date arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stratum.functions._util import col

# Fixed value: open-ended SCD-2 validity sentinel.
OPEN_END = "9999-12-31 00:00:00"


def ts_literal(value: str) -> Column:
    """A TIMESTAMP_NTZ literal (no session time zone involved)."""
    return F.lit(value).cast("timestamp_ntz")


def try_parse_ts(c: str | Column) -> Column:
    """text -> TIMESTAMP_NTZ, NULL when the text is not a timestamp."""
    return col(c).try_cast("timestamp_ntz")


def ts_text(c: str | Column) -> Column:
    """timestamp as text with exactly three fraction digits (the dialect's VARCHAR form)."""
    return F.date_format(col(c), "yyyy-MM-dd HH:mm:ss.SSS")


def date_parts(d: str | Column, prefix: str = "") -> dict[str, Column]:
    """calendar attributes of a date; weekend = Sunday or Saturday."""
    x = col(d)
    return {
        f"{prefix}year": F.year(x),
        f"{prefix}quarter": F.quarter(x),
        f"{prefix}month": F.month(x),
        f"{prefix}month_name": F.date_format(x, "MMM"),
        f"{prefix}day_of_month": F.dayofmonth(x),
        f"{prefix}day_name": F.date_format(x, "EEE"),
        f"{prefix}is_weekend": F.dayofweek(x).isin(1, 7),
    }


def days_between(start: str | Column, end: str | Column) -> Column:
    """``DATEDIFF(DAY, start, end)`` = end - start in days (a whole NUMBER: BIGINT)."""
    return F.datediff(col(end), col(start)).cast("bigint")


def add_days(c: str | Column, n: int | Column) -> Column:
    return col(c) + F.make_interval(days=F.lit(n) if isinstance(n, int) else n)


def add_hours(c: str | Column, n: int | Column) -> Column:
    return col(c) + F.make_interval(hours=F.lit(n) if isinstance(n, int) else n)


def add_minutes(c: str | Column, n: int | Column) -> Column:
    return col(c) + F.make_interval(mins=F.lit(n) if isinstance(n, int) else n)
