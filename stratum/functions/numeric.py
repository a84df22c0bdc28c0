"""F8 rate percentages, F9 safe ratios, F10 ad metrics, F15 flag sums."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stratum.functions._util import col


def rate_pct(num: str | Column, den: str | Column, precision: int = 18, scale: int = 2) -> Column:
    """F8: ``CASE WHEN d > 0 THEN ROUND(n*100.0/d, 2) ELSE 0 END`` as DECIMAL(18,2).

    Exact decimal arithmetic. The column is wide enough for any rate of two 15-digit counts: a rate above 999.99
    percent is a value, not a NULL.
    """
    n = col(num).cast("decimal(20,0)")
    d = col(den).cast("decimal(20,0)")
    r = F.when(d > 0, F.round(n * F.lit(100) / d, scale)).otherwise(F.lit(0))
    return r.try_cast(f"decimal({precision},{scale})")


def safe_ratio(num: str | Column, den: str | Column, factor=1, scale: int = 2) -> Column:
    """``ROUND(a*k / NULLIF(b, 0), scale)``: NULL when the denominator is 0 or NULL."""
    d = col(den)
    return F.round(col(num) * F.lit(factor) / F.nullif(d, F.lit(0)), scale)


def exact_ratio(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    """``ROUND(num / NULLIF(den, 0), scale)`` over whole numbers (counts, cents), as DECIMAL(38, scale).

    Operands are narrowed to DECIMAL(24,0)/DECIMAL(20,0) so Spark keeps 14 fraction digits in the
    quotient: rounding a ratio of sums then never double-rounds a half (a DECIMAL(38,x) operand
    would leave only 6 digits).
    """
    q = col(num).cast("decimal(24,0)") / F.nullif(col(den), F.lit(0)).cast("decimal(20,0)")
    return F.round(q, scale).cast(f"decimal(38,{scale})")


def round_div_long(num: Column, den: Column) -> Column:
    """``ROUND(num / den)`` for whole numbers, half away from zero, in exact long arithmetic (den > 0)."""
    q = F.call_function("div", F.lit(2) * F.abs(num) + den, F.lit(2) * den)
    return F.when(num < 0, -q).otherwise(q)


def _scaled(units: Column, scale: int) -> Column:
    # units / 10^scale as DECIMAL(18, scale): exact, because the double nearest to units/10^scale
    # rounds back to it at ``scale`` digits while |units| < 2^53
    return (units.cast("double") / F.lit(10 ** scale)).cast(f"decimal(18,{scale})")


def ad_metrics(spend: str | Column, clicks: str | Column, impressions: str | Column,
               reach: str | Column | None = None) -> dict[str, Column]:
    """derived ad metrics with denominators floored at 1.

    CPC = spend / clicks, CPM = spend / impressions * 1000 (both 2 dp), CTR = clicks / impressions * 100
    (4 dp), FREQUENCY = impressions / reach (2 dp). Computed on whole cents in long arithmetic: the
    same exact half-up result as decimal division, without per-row 38-digit decimals.
    """
    cents = F.round(col(spend).cast("double") * 100).cast("long")
    c, i = col(clicks).cast("long"), col(impressions).cast("long")
    one = F.lit(1).cast("long")
    out = {
        "cpc": _scaled(round_div_long(cents, F.greatest(c, one)), 2),
        "cpm": _scaled(round_div_long(cents * 1000, F.greatest(i, one)), 2),
        "ctr": _scaled(round_div_long(c * 1000000, F.greatest(i, one)), 4),
    }
    if reach is not None:
        out["frequency"] = _scaled(round_div_long(i * 100, F.greatest(col(reach).cast("long"), one)), 2)
    return out


def flag_to_int(flag: str | Column) -> Column:
    """``CASE WHEN flag THEN 1 ELSE 0 END``; a NULL flag counts 0."""
    return F.when(col(flag), F.lit(1)).otherwise(F.lit(0))


def count_true(flag: str | Column) -> Column:
    """A4: ``SUM(CASE WHEN flag THEN 1 ELSE 0 END)`` as BIGINT (NULL over an empty input)."""
    return F.sum(flag_to_int(flag)).cast("bigint")
