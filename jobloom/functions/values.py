"""Numbers and dates: forgiving casts, posting time and mid salary."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from jobloom.functions.text import _col


def to_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def posted_timestamp(c: Column | str) -> Column:
    """Timestamp, or null where the text is not one (never a failed job)."""
    return F.try_to_timestamp(_col(c).cast("string"))


def mid_salary(low: Column | str, high: Column | str) -> Column:
    """Mean when both ends are known, otherwise the upper end (null if that is missing)."""
    lo, hi = _col(low), _col(high)
    return F.when(lo.isNotNull() & hi.isNotNull(), (lo + hi) / 2).otherwise(hi)


def without_zone(c: Column | str) -> Column:
    """Timestamp text without a trailing zone or offset: its wall-clock reading."""
    return F.regexp_replace(
        _col(c).cast("string"), r"(:\d{2}(?:\.\d+)?)\s*(?:Z|UTC|[+-]\d{2}:?\d{2})$", "$1")
