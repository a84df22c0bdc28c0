"""F6 natural-key hashes and F7 record hashes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from stratum.functions._util import col

SEP = "|"


def _text(c: Column) -> Column:
    return c.cast("string")


def hash_key(*cols: str | Column, null_as_empty: bool = True) -> Column:
    """``MD5(coalesce(a,'') || '|' || coalesce(b,'') ...)``.

    With ``null_as_empty=False`` it is the bare ``MD5(a || '|' || b)``, NULL if any part is NULL.
    (``concat_ws`` would silently drop NULL parts and give different keys.)
    """
    parts = []
    for i, c in enumerate(cols):
        t = _text(col(c))
        parts.append(F.coalesce(t, F.lit("")) if null_as_empty else t)
        if i < len(cols) - 1:
            parts.append(F.lit(SEP))
    return F.md5(F.concat(*parts))


def row_hash(*cols: str | Column) -> Column:
    """SHA-256 over '|'-joined text values; NULL is written as 'None'."""
    return F.sha2(F.concat_ws(SEP, *[F.coalesce(_text(col(c)), F.lit("None")) for c in cols]), 256)


def row_hash32(*cols: str | Column) -> Column:
    """the 32-character truncated record hash."""
    return F.substring(row_hash(*cols), 1, 32)
