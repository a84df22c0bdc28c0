"""Q1-Q8: data-quality summaries, layer counts and integrity checks (expect FAILURES = 0)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stratum.functions.numeric import count_true, exact_ratio


def dq_branch(df: DataFrame, table_name: str, valid_active_flags: Sequence[str] = ("is_valid_record",),
              valid_detail: str | None = None) -> DataFrame:
    """One DQ row: total, valid+active, detail validity count, deleted, validity % (A4 + F9)."""
    active = F.lit(True)
    for f in valid_active_flags:
        active = active & F.col(f)
    active = active & ~F.col("is_deleted")
    total = F.count(F.lit(1))
    return df.agg(
        F.lit(table_name).alias("table_name"),
        total.alias("total_rows"),
        count_true(active).alias("valid_active_rows"),
        (count_true(valid_detail) if valid_detail else F.lit(None).cast("bigint")).alias("valid_emails"),
        count_true("is_deleted").alias("deleted_rows"),
        exact_ratio(count_true("is_valid_record") * 100, total, 2).cast("decimal(10,2)").alias("validity_pct"))


def stack(parts: Sequence[DataFrame]) -> DataFrame:
    """Positional UNION ALL (names from the first branch)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def digest(df: DataFrame, name: str) -> DataFrame:
    """One row per table: its rows and an order-free digest of all its columns (the sum of 48 bits of each row's MD5 over its
    values as text, in column-name order). Equal tables have equal digests whatever wrote them, in whatever order."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in sorted(df.columns)]
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", *text)), 1, 12), 16, 10).cast("decimal(38,0)")
    return df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                  F.coalesce(F.sum(bits), F.lit(0)).cast("decimal(38,0)").alias("digest"))


def row_counts(tables: dict[str, DataFrame], layer: str | None = None) -> DataFrame:
    """A1/Q3: one (layer, table_name, row_count) row per table, stacked."""
    parts = []
    for name, df in tables.items():
        cols = [F.lit(layer).alias("layer")] if layer is not None else []
        parts.append(df.agg(*cols, F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")))
    return stack(parts)


def empty_tables(counts: DataFrame) -> DataFrame:
    """Q4: tables with zero rows."""
    return counts.filter(F.col("row_count") == 0)


def check_null_keys(df: DataFrame, key: str, check_name: str) -> DataFrame:
    """Q5."""
    return df.filter(F.col(key).isNull()).agg(F.lit(check_name).alias("check_name"),
                                              F.count(F.lit(1)).alias("failures"))


def check_duplicates(df: DataFrame, key: str, check_name: str) -> DataFrame:
    """Q6: COUNT(*) - COUNT(DISTINCT key)."""
    return df.agg(F.lit(check_name).alias("check_name"),
                  (F.count(F.lit(1)) - F.count_distinct(key)).alias("failures"))


def check_orphans(fact: DataFrame, dim: DataFrame, sk: str, check_name: str) -> DataFrame:
    """Q7: fact surrogate keys that no dimension row has."""
    orphans = fact.filter(F.col(sk).isNotNull()).join(dim.select(sk), sk, "left_anti")
    return orphans.agg(F.lit(check_name).alias("check_name"), F.count(F.lit(1)).alias("failures"))


def check_current_in_source(dim: DataFrame, source: DataFrame, key: str, check_name: str) -> DataFrame:
    """Q8: current Gold keys missing in Silver (J7 as an anti join)."""
    missing = dim.filter("is_current").join(source.select(key), key, "left_anti")
    return missing.agg(F.lit(check_name).alias("check_name"), F.count(F.lit(1)).alias("failures"))
