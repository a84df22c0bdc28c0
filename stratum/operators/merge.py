"""M1-M3 SCD-1 upsert with soft delete and late-data guard; M8 fact upsert.

The target is an immutable snapshot; the merge returns the next snapshot. Parquet tables have
no row-level MERGE, so the clauses are evaluated over one full outer join on the keys:

1. matched and ``src.deleted = TRUE``  -> deleted := TRUE, updated_at := run_ts (nothing else)
2. matched and (``tgt.seq < src.seq`` or ``tgt.seq IS NULL``) -> overwrite ``update_cols``
   (including the delete flag, so a newer live row resurrects a deleted one), updated_at := run_ts
3. not matched and ``src.deleted = FALSE`` -> insert ``insert_cols``, loaded_at := run_ts
4. otherwise no change.

First matching clause wins, NULL comparisons are false, exactly as in the reference.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

_T, _S = "__t_", "__s_"


def split_null_keys(source: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Route rows whose key has a NULL part to quarantine (the reference's NOT NULL failure)."""
    ok = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return source.filter(ok), source.filter(~ok)


def scd1_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
               update_cols: Sequence[str], insert_cols: Sequence[str], run_ts: Column,
               seq_col: str | None = "audit_updated_at", deleted_col: str | None = "is_deleted",
               loaded_col: str | None = "silver_loaded_at", updated_col: str | None = "silver_updated_at",
               delete_clause: bool = True, seq_guard: bool = True,
               insert_only_live: bool = True, only_source: bool = False) -> DataFrame:
    """Apply one deduplicated ``source`` batch to ``target``; returns the new target snapshot.

    ``source`` must hold at most one row per key (see :func:`stratum.operators.dedup_latest`).
    Rows with a NULL key part are dropped here; use :func:`split_null_keys` to keep them.
    The output has exactly the target's columns, in the target's order. ``only_source`` leaves out the target's rows whose
    key the batch does not have, and keeps the rows where the batch's keys are (no full outer join).
    """
    tcols = target.columns
    scols = source.columns
    source, _ = split_null_keys(source, keys)
    t = target.select(*[F.col(c).alias(_T + c) for c in tcols], F.lit(True).alias("__t_present"))
    t = t.hint("merge") if only_source else t      # the whole table, never a broadcast: its estimate is far too small
    s = source.select(*[F.col(c).alias(_S + c) for c in scols], F.lit(True).alias("__s_present"))
    on = reduce(lambda a, b: a & b, [F.col(_T + k) == F.col(_S + k) for k in keys])
    j = t.join(s, on, "right" if only_source else "full_outer")

    tp = F.col("__t_present").isNotNull()
    sp = F.col("__s_present").isNotNull()
    matched = tp & sp
    false = F.lit(False)
    s_del = F.col(_S + deleted_col) if deleted_col else F.lit(None).cast("boolean")

    c1 = (matched & F.coalesce(s_del == True, false)) if delete_clause else false  # noqa: E712
    if seq_guard:
        newer = (F.col(_T + seq_col) < F.col(_S + seq_col)) | F.col(_T + seq_col).isNull()
        c2 = matched & ~c1 & F.coalesce(newer, false)
    else:
        c2 = matched & ~c1
    c3 = (~tp & F.coalesce(s_del == False, false)) if insert_only_live else ~tp  # noqa: E712
    # the clause outcome is computed once per row; the column expressions below only read it
    j = j.select("*", c1.alias("__c1"), c2.alias("__c2"), c3.alias("__c3"))
    c1, c2, c3 = F.col("__c1"), F.col("__c2"), F.col("__c3")

    update_set, insert_set = set(update_cols), set(insert_cols)
    out = []
    for c in tcols:
        tc = F.col(_T + c)
        sc = F.col(_S + c) if c in scols else None
        ins = sc if (sc is not None and (c in insert_set or c in keys)) else F.lit(None)
        if c in keys and only_source:
            out.append((sc if source.schema[c].dataType == target.schema[c].dataType
                        else sc.cast(target.schema[c].dataType)).alias(c))
            continue
        if c in keys:
            e = F.when(tp, tc).otherwise(sc)
        elif c == deleted_col:
            e = F.when(c1, F.lit(True)).when(c2, sc).when(tp, tc).otherwise(ins)
        elif c == updated_col:
            e = F.when(c1 | c2, run_ts).when(tp, tc).otherwise(F.lit(None))
        elif c == loaded_col:
            e = F.when(tp, tc).otherwise(run_ts)
        elif c in update_set and sc is not None:
            e = F.when(c2, sc).when(tp, tc).otherwise(ins)
        else:
            e = F.when(tp, tc).otherwise(ins)
        out.append(e.cast(target.schema[c].dataType).alias(c))
    return j.filter(tp | c3).select(*out)


def insert_into_empty(source: DataFrame, keys: Sequence[str], *, columns: Sequence[str], run_ts: Column,
                      deleted_col: str | None = "is_deleted", loaded_col: str | None = "silver_loaded_at",
                      updated_col: str | None = "silver_updated_at", insert_only_live: bool = True) -> DataFrame:
    """:func:`scd1_merge` into an empty target: only clause 3 can fire, so no join is needed."""
    source, _ = split_null_keys(source, keys)
    if insert_only_live and deleted_col:
        source = source.filter(F.coalesce(F.col(deleted_col) == False, F.lit(False)))  # noqa: E712
    extra = []
    if loaded_col:
        extra.append(run_ts.alias(loaded_col))
    if updated_col:
        extra.append(F.lit(None).cast("timestamp_ntz").alias(updated_col))
    return source.select(*columns, *extra)


def fact_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], *, run_ts: Column,
               loaded_col: str | None = "gold_loaded_at", updated_col: str | None = "gold_updated_at",
               update_cols: Sequence[str] | None = None, only_source: bool = False) -> DataFrame:
    """M8: matched -> overwrite every non-key column; not matched -> insert. No guard, no delete."""
    cols = [c for c in source.columns if c not in keys]
    return scd1_merge(target, source, keys, update_cols=update_cols if update_cols is not None else cols,
                      insert_cols=source.columns, run_ts=run_ts, seq_col=None, deleted_col=None,
                      loaded_col=loaded_col, updated_col=updated_col, delete_clause=False,
                      seq_guard=False, insert_only_live=False, only_source=only_source)
