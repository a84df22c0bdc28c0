"""F1 trim/case cleaning, F2 proper case, F5 NULL-propagating concatenation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stratum.functions._util import col

# INITCAP word delimiters of the warehouse dialect (its public documentation):
# any whitespace, plus  ! ? @ " ^ # $ & ~ _ , . : ; + - * % / | \ [ ] ( ) { } < >
# An apostrophe and digits are NOT delimiters ("o'brien" -> "O'brien").
INITCAP_DELIMITER_CLASS = r"""[\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>]"""


def clean_trim(c: str | Column) -> Column:
    return F.trim(col(c))


def clean_lower(c: str | Column) -> Column:
    return F.trim(F.lower(col(c)))


def clean_upper(c: str | Column) -> Column:
    return F.trim(F.upper(col(c)))


def proper_case(c: str | Column) -> Column:
    """INITCAP with the dialect's delimiters: lower everything, upper the first letter of each word.

    ``split`` with a look-behind keeps each delimiter at the end of its word, so joining the
    pieces back with '' restores the original spacing. NULL stays NULL, '' stays ''.
    """
    words = F.split(F.lower(col(c)), f"(?<={INITCAP_DELIMITER_CLASS})")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), "")


def concat_null(*cols: str | Column) -> Column:
    """``a || b``: NULL if any input is NULL."""
    return F.concat(*[col(c) for c in cols])


def full_name(first: str | Column, last: str | Column) -> Column:
    """COALESCE-guarded ``first || ' ' || last``; two NULLs give ' '."""
    return F.concat(F.coalesce(col(first), F.lit("")), F.lit(" "), F.coalesce(col(last), F.lit("")))
