"""Text dates: ISO predicate, parsing, buckets and rolling windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
# Reference date for the rolling windows (a parameter, never the wall clock).
DEFAULT_AS_OF = dt.date(2024, 12, 31)


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_iso_date(c="review_date") -> Column:
    """FLT-3: text looks like YYYY-MM-DD (null input -> null -> filtered out)."""
    return _as_col(c).rlike(ISO_DATE_PATTERN)


def iso_to_date(c="review_date") -> Column:
    """DAT-1: text to DATE; impossible dates (2024-13-45) become null instead of failing."""
    return F.try_to_date(_as_col(c), "yyyy-MM-dd")


def iso_date_or_null(c="review_date") -> Column:
    """Date only when the text passes the ISO predicate."""
    return F.when(is_iso_date(c), iso_to_date(c))


def month_bucket(d: Column) -> Column:
    return F.trunc(d, "month")


def quarter_bucket(d: Column) -> Column:
    return F.trunc(d, "quarter")


def months_back(as_of: dt.date, n: int) -> Column:
    """DAT-3: as_of - INTERVAL 'n months' (clamps to month end)."""
    return F.add_months(F.lit(as_of), -n)
