"""SCD-2 history queries: J8-J11, A5/A6 and the reports built on them (Q10-Q15).

All of them are joins or aggregations keyed by the natural key (plus a timestamp where the
relation allows it), so they shuffle by key and never gather a key's versions in the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratum.operators.skew import heavy_keys, key_hash

from stratum.functions.numeric import count_true


def keys_with_multiple_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A5: ``GROUP BY k HAVING COUNT(*) > 1`` -> key, row_count (partial counts before the shuffle)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .filter(F.col("row_count") > 1))


def multi_version_rows(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every version of keys that have more than one (``k IN (SELECT ... HAVING COUNT(*)>1)``)."""
    return dim.join(keys_with_multiple_rows(dim, keys).select(*keys), list(keys), "left_semi")


def version_counts(dim: DataFrame, keys: Sequence[str], current_col: str = "is_current") -> DataFrame:
    """Q12: total / current / historical versions for keys with history."""
    return (dim.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("total_versions"),
                 count_true(F.col(current_col)).alias("current_versions"),
                 count_true(~F.col(current_col)).alias("historical_versions"))
            .filter(F.col("total_versions") > 1))


def current_vs_previous(dim: DataFrame, keys: Sequence[str], compare: Sequence[str],
                        end_col: str = "effective_end_date", current_col: str = "is_current") -> DataFrame:
    """Current version beside *every* earlier version of the same key."""
    cur = dim.filter(F.col(current_col)).select(*keys, *[F.col(c).alias(f"current_{c}") for c in compare])
    prev = dim.filter(~F.col(current_col)).select(
        *keys, *[F.col(c).alias(f"previous_{c}") for c in compare], F.col(end_col).alias("changed_at"))
    return cur.join(prev, list(keys), "inner")


def adjacent_versions(dim: DataFrame, keys: Sequence[str], compare: Sequence[str],
                      start_col: str = "effective_start_date", end_col: str = "effective_end_date",
                      current_col: str = "is_current") -> DataFrame:
    """The version that ended exactly when the current one started.

    An equi-join on (key, end = start): the timestamp is part of the hash key, so even a key
    with very many versions spreads over tasks.
    """
    cur = dim.filter(F.col(current_col)).select(
        *keys, F.col(start_col).alias("__edge"), *[F.col(c).alias(f"current_{c}") for c in compare])
    prev = dim.select(*keys, F.col(end_col).alias("__edge"), *[F.col(c).alias(f"previous_{c}") for c in compare])
    return cur.join(prev, [*keys, "__edge"], "inner").withColumnRenamed("__edge", "changed_at")


def as_of(dim: DataFrame, instant: Column, start_col: str = "effective_start_date",
          end_col: str = "effective_end_date") -> DataFrame:
    """J11 with one instant: versions valid at ``instant`` (half-open ``[start, end)``)."""
    return dim.filter((F.col(start_col) <= instant) & (F.col(end_col) > instant))


def as_of_join(facts: DataFrame, dim: DataFrame, keys: Sequence[str], ts_col: str,
               start_col: str = "effective_start_date", end_col: str = "effective_end_date",
               how: str = "left") -> DataFrame:
    """J11 with per-row instants: equi-join on the key plus a range residual (never a pure range join)."""
    d = dim.select(*[F.col(c).alias(f"__dim_{c}") if c in keys else F.col(c) for c in dim.columns])
    cond = [facts[k] == d[f"__dim_{k}"] for k in keys]
    cond += [d[start_col] <= facts[ts_col], d[end_col] > facts[ts_col]]
    out = facts.join(d, cond, how)
    return out.drop(*[f"__dim_{k}" for k in keys])


def as_of_sweep(facts: DataFrame, dim: DataFrame, keys: Sequence[str], ts_col: str, start_col: str = "effective_start_date",
                end_col: str = "effective_end_date", heavy: list[int] | None = None) -> DataFrame:
    """J11 as a sweep, the left :func:`as_of_join` for versions that do not overlap: facts and versions are put in one time
    line per key and the last version is carried forward. One shuffle and one sort, whatever the number of versions.

    The rows of a hot key (found by a sketch) are dealt out by month as well; its versions are copied to each month of the
    facts that they reach into, which at most ``skew.MOST_HEAVY`` keys do."""
    keys, values = list(keys), [c for c in dim.columns if c not in keys]
    heavy = heavy_keys(facts, keys) if heavy is None else heavy
    month = lambda c: F.year(c) * 12 + F.month(c)
    hot = key_hash(keys).isin(heavy) if heavy else F.lit(False)
    own, months = F.lit(0), F.array(F.lit(0))
    if heavy:
        first, last = facts.filter(hot).agg(F.min(month(ts_col)), F.max(month(ts_col))).first()
        lo, hi = F.greatest(month(start_col), F.lit(first)), F.least(month(end_col), F.lit(last))
        own = F.when(hot, F.coalesce(month(ts_col), F.lit(0))).otherwise(F.lit(0))
        months = F.when(hot, F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))).otherwise(months)
    line = (dim.select(*keys, F.explode(months).alias("__part"), F.col(start_col).alias("__at"), F.lit(0).alias("__kind"),
                       F.struct(*values).alias("__version"), F.lit(None).cast(facts.schema).alias("__fact"))
            .unionByName(facts.select(*keys, own.alias("__part"), F.col(ts_col).alias("__at"), F.lit(1).alias("__kind"),
                                      F.lit(None).cast(dim.select(*values).schema).alias("__version"),
                                      F.struct(*facts.columns).alias("__fact"))))
    # a version is in force from the instant it starts at, so it comes before the facts of that instant
    so_far = Window.partitionBy(*keys, "__part").orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    carried = line.withColumn("__version", F.last("__version", ignorenulls=True).over(so_far)).filter("__kind = 1")
    known = F.when(carried["__version"][end_col] > carried["__at"], carried["__version"])
    for k in keys:
        known = F.when(F.col(k).isNotNull(), known)
    return carried.withColumn("__version", known).select("__fact.*", *[F.col("__version")[c].alias(c) for c in values])


def versions_opened_since(dim: DataFrame, keys: Sequence[str], since: Column,
                          start_col: str = "effective_start_date") -> DataFrame:
    """Keys with more than one version opened at or after ``since``."""
    return (dim.filter(F.col(start_col) >= since).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("num_versions")).filter(F.col("num_versions") > 1))
