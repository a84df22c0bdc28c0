"""V1-V7 validity rules and P2 active/valid predicate. Every rule returns a non-NULL boolean."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from stratum.functions._util import col

# Fixed value: the e-mail shape test used by the reference's contact cleansing.
EMAIL_LIKE_PATTERN = "%_@_%.__%"


def valid_email(raw: str | Column) -> Column:
    """V1 on the *raw* value: FALSE if NULL/blank, FALSE if it does not look like a@b.cc."""
    r = col(raw)
    return (F.when(r.isNull() | (F.trim(r) == ""), F.lit(False))
            .when(~r.like(EMAIL_LIKE_PATTERN), F.lit(False))
            .otherwise(F.lit(True)))


def valid_required(*cols: str | Column) -> Column:
    """V2/V7: TRUE iff every listed column is non-NULL."""
    return reduce(lambda a, b: a & b, [col(c).isNotNull() for c in cols])


def valid_required_nonblank(not_null: list[str] | tuple = (), nonblank: list[str] | tuple = ()) -> Column:
    """V3: FALSE if a required value is NULL or a required text trims to ''."""
    parts = [col(c).isNotNull() for c in not_null]
    parts += [F.coalesce(F.trim(col(c)) != "", F.lit(False)) for c in nonblank]
    return reduce(lambda a, b: a & b, parts)


def valid_event_time(ts: str | Column, run_ts: Column) -> Column:
    """V4: FALSE if NULL or later than the run time."""
    t = col(ts)
    return F.when(t.isNull(), F.lit(False)).when(t > run_ts, F.lit(False)).otherwise(F.lit(True))


def valid_date_range(start: str | Column, stop: str | Column, run_date: Column) -> Column:
    """V5: FALSE if either end NULL, start after stop, or start after the run date."""
    s, e = col(start), col(stop)
    return (F.when(s.isNull() | e.isNull(), F.lit(False))
            .when(s > e, F.lit(False))
            .when(s > run_date, F.lit(False))
            .otherwise(F.lit(True)))


def valid_metrics(period: str | Column, requests: str | Column, delivered: str | Column) -> Column:
    """V6: FALSE if the period is blank, a count is negative, or delivered > requests.

    Comparisons with NULL counts are unknown and fall through to TRUE, as in the reference's CASE.
    """
    p, r, d = col(period), col(requests), col(delivered)
    return (F.when(p.isNull() | (F.trim(p) == ""), F.lit(False))
            .when((r < 0) | (d < 0), F.lit(False))
            .when(d > r, F.lit(False))
            .otherwise(F.lit(True)))


def active_valid(valid: str | Column = "is_valid_record", deleted: str | Column = "is_deleted",
                 *more_valid: str | Column) -> Column:
    """``valid = TRUE AND [more = TRUE ...] AND deleted = FALSE``; a NULL flag fails."""
    cond = F.coalesce(col(valid), F.lit(False))
    for m in more_valid:
        cond = cond & F.coalesce(col(m), F.lit(False))
    return cond & F.coalesce(~col(deleted), F.lit(False))


def null_default_differs(a: Column, b: Column, default) -> Column:
    """``COALESCE(a, x) != COALESCE(b, x)`` -- NULL counts as equal to the default."""
    d = F.lit(default)
    return F.coalesce(a, d) != F.coalesce(b, d)


def any_tracked_differs(pairs: list[tuple[Column, Column, object]]) -> Column:
    return reduce(lambda x, y: x | y, [null_default_differs(a, b, d) for a, b, d in pairs])
