"""Numeric helpers with pinned semantics (ROUND on numeric, percentages)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ROUND_SCALE = "decimal(18,6)"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rank_key(c) -> Column:
    """Value used for ordering/ranking float aggregates: the decimal(18,6) image, so last-bit
    differences of a double sum never change a rank."""
    return _as_col(c).cast(ROUND_SCALE)


def pg_round(c, n: int) -> Column:
    """ROUND(x::numeric, n): decimal rounding half away from zero, returned as double."""
    return F.round(_as_col(c).cast(ROUND_SCALE), n).cast("double")


def percent(num, den, n: int = 2) -> Column:
    """ROUND(num * 100.0 / den, n) in double arithmetic; null when den is 0."""
    ratio = _as_col(num).cast("double") * F.lit(100.0) / F.when(_as_col(den) != 0, _as_col(den).cast("double"))
    return pg_round(ratio, n)


def flag(cond: Column) -> Column:
    """0/1 integer indicator; null conditions count as 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))
