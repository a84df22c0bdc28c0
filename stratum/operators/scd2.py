"""M4-M7: SCD-2 dimension maintenance (close changed versions, open new ones) in one pass.

The current versions and the source meet in a single full outer join on the natural key:

* current row, no source row, or no tracked change -> unchanged
* current row and a tracked change                 -> closed: end := run_ts, is_current := FALSE
* source row with no current row or with a change  -> new version opened at run_ts
* historical (closed) rows never enter the join.

Tracked columns compare with the dialect's NULL-default rule (``COALESCE(a,'') != COALESCE(b,'')``),
so NULL -> '' or 0 -> NULL opens no version; carried columns are copied but never open one.
Deleted or invalid source rows are filtered out before the join and therefore do not close a row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType, LongType, TimestampNTZType, BooleanType

from stratum.functions.temporal import OPEN_END, ts_literal
from stratum.functions.validity import null_default_differs
from stratum.operators.sized import sized
from stratum.operators.surrogate import assign_surrogate_keys_counted, max_key

_D, _S = "__d_", "__s_"


@dataclass(frozen=True)
class Scd2Spec:
    sk_col: str
    keys: Sequence[str]
    tracked: dict[str, object]          # column -> default used by the NULL-default comparison
    carried: Sequence[str] = ()
    start_col: str = "effective_start_date"
    end_col: str = "effective_end_date"
    current_col: str = "is_current"
    loaded_col: str = "gold_loaded_at"
    updated_col: str = "gold_updated_at"
    order_extra: Sequence[str] = field(default_factory=tuple)

    @property
    def attr_cols(self) -> list[str]:
        return list(self.keys) + list(self.tracked) + [c for c in self.carried if c not in self.tracked]

    @property
    def dim_cols(self) -> list[str]:
        return [self.sk_col, *self.attr_cols, self.start_col, self.end_col, self.current_col,
                self.loaded_col, self.updated_col]


def _differs(a: Column, b: Column, default) -> Column:
    """F11 NULL-default inequality; ``default=None`` compares NULL-safely (a NULL equals only NULL)."""
    if default is None:
        return ~a.eqNullSafe(b)
    return F.coalesce(null_default_differs(a, b, default), F.lit(False))


def empty_dimension(spark, spec: Scd2Spec, source_schema: StructType) -> DataFrame:
    fields = [StructField(spec.sk_col, LongType())]
    fields += [StructField(c, source_schema[c].dataType) for c in spec.attr_cols]
    fields += [StructField(spec.start_col, TimestampNTZType()), StructField(spec.end_col, TimestampNTZType()),
               StructField(spec.current_col, BooleanType()), StructField(spec.loaded_col, TimestampNTZType()),
               StructField(spec.updated_col, TimestampNTZType())]
    return spark.createDataFrame([], StructType(fields))


def scd2_apply(dim: DataFrame | None, source: DataFrame, spec: Scd2Spec, run_ts: Column) -> DataFrame:
    """One SCD-2 run over a whole dimension. ``source`` must already be filtered (valid, not deleted) and unique
    per key.

    ``dim=None`` starts an empty dimension. New versions get surrogate keys after the largest one in ``dim``, in
    natural-key order (M6). For a part of a dimension use :func:`scd2_changes`, which has to be told the key base.
    """
    if dim is None:
        return scd2_changes(None, source, spec, run_ts, 0)[0]
    dim = dim.select(*spec.dim_cols)
    current = dim.filter(F.col(spec.current_col))
    changes, _ = scd2_changes(current, source, spec, run_ts, max_key(dim, spec.sk_col))
    replaced = changes.filter(~F.col(spec.current_col)).select(spec.sk_col)
    return dim.join(replaced, spec.sk_col, "left_anti").unionByName(changes)


def scd2_changes(current: DataFrame | None, source: DataFrame, spec: Scd2Spec, run_ts: Column,
                 sk_base: int, most: int | None = None) -> tuple[DataFrame, int]:
    """The rows an SCD-2 run writes (versions it closes, versions it opens), and the key base of the next run.

    ``current`` holds the current rows of at least the source's keys; ``sk_base`` is the largest surrogate key the
    whole dimension has handed out so far. ``most``: the rows that ``current`` has at most, if that is known.
    """
    attrs = spec.attr_cols
    src = source.select(*attrs)

    def open_versions(rows):
        keyed, n = assign_surrogate_keys_counted(rows, [*spec.keys, *spec.order_extra], spec.sk_col, base=sk_base)
        return keyed.select(spec.sk_col, *attrs, run_ts.alias(spec.start_col), ts_literal(OPEN_END).alias(spec.end_col),
                            F.lit(True).alias(spec.current_col), run_ts.alias(spec.loaded_col),
                            F.lit(None).cast("timestamp_ntz").alias(spec.updated_col)), sk_base + n

    if current is None:      # an empty dimension: everything is new, nothing to join
        return open_versions(src)
    d = current.select(*[F.col(c).alias(_D + c) for c in spec.dim_cols], F.lit(True).alias("__d_present"))
    s = src.select(*[F.col(c).alias(_S + c) for c in attrs])
    on = reduce(lambda a, b: a & b, [F.col(_D + k) == F.col(_S + k) for k in spec.keys])
    j = s.join(sized(d, most), on, "left")
    dp = F.col("__d_present").isNotNull()
    changed = dp & reduce(lambda a, b: a | b, [_differs(F.col(_S + c), F.col(_D + c), dflt)
                                               for c, dflt in spec.tracked.items()])
    closed = j.filter(changed).select(
        *[F.col(_D + c).alias(c) for c in [spec.sk_col, *attrs, spec.start_col]], run_ts.alias(spec.end_col),
        F.lit(False).alias(spec.current_col), F.col(_D + spec.loaded_col).alias(spec.loaded_col),
        run_ts.alias(spec.updated_col))
    opened = j.filter(~dp | changed).select(*[F.col(_S + c).alias(c) for c in attrs])
    opened, base = open_versions(opened)
    return closed.unionByName(opened), base


def scd2_commit(table, source: DataFrame, spec: Scd2Spec, run_ts: Column, version: int) -> None:
    """One SCD-2 run on a stored dimension, as its commit ``version``; a version that is committed is left alone. Only
    the current rows of the source's keys are read; the largest surrogate key is part of the commit."""
    last = table.last_commit()
    if last is not None and version <= last:
        return
    # the source is read for its keys, for the versions it closes and for those it opens: computed once, and counted
    source = source.select(*spec.attr_cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        most = source.count()
        held = table.read_for(source, list(spec.keys), most=most)
        current = None if held is None else held.filter(F.col(spec.current_col))      # one for a key of the source
        rows, base = scd2_changes(current, source, spec, run_ts, table.meta().get("sk_base", 0), most)
        table.commit(rows, version, meta={"sk_base": base})
    finally:
        source.unpersist()
