"""Numeric parsing and rounding expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mean "no reading".
MISSING_WORDS = ["nr", "ausente", "nan"]

_NUMBER = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$"


def parse_number(col: Column | str) -> Column:
    """Text to DOUBLE; decimal comma allowed, anything unreadable or not finite becomes NULL.

    The shape is checked first because a plain cast also takes suffixes such as ``1d``.
    """
    text = F.regexp_replace(F.trim(F.regexp_replace(col, r"[\s\p{Z}]+", " ")), ",", ".")
    readable = text.rlike(_NUMBER) & ~F.lower(text).isin(*MISSING_WORDS)
    value = text.try_cast("double")
    return F.when(readable & (F.abs(value) < float("inf")), value)


def nan_to_null(col: Column | str) -> Column:
    return F.nullif(F.nanvl(col, F.lit(None).cast("double")), F.lit(float("nan")))


def round_half_up(col: Column, digits: int = 2) -> Column:
    """Decimal rounding, half away from zero, of a DOUBLE whose noise is below 1e-6.

    Values of 1e15 and more, which have no such digits, and infinities come back unchanged.
    """
    exact = F.round(F.when(F.abs(col) < 1e15, col).cast("decimal(24,6)"), digits)
    return F.coalesce(exact.cast("double"), col.cast("double"))


def safe_mean(total: Column, count: Column) -> Column:
    """Mean from a sum and a count; NULL when nothing was counted."""
    return total / F.nullif(count, F.lit(0))
