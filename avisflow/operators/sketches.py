"""Distinct counts that merge: HyperLogLog sketches kept per fine group, rolled up without the rows.

A sketch has a fixed size (about 2^LG_K bytes at most) whatever it has seen, so a table of sketches
per place and month answers for quarters, years or all places by merging its own rows; an exact
distinct count has to read the reviews again for each. Nulls do not count, as in COUNT(DISTINCT).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LG_K = 12
#: Three standard errors of a merged sketch: 1.04 / sqrt(2^LG_K) each.
SIGMAS = 3


def _sketch(name: str) -> str:
    return f"{name}_sketch"


def distinct_sketches(df: DataFrame, keys: list, columns: dict[str, Column], lg_k: int = LG_K) -> DataFrame:
    """One row per group of ``keys`` with a sketch of the distinct values of every named column."""
    return df.groupBy(*keys).agg(*[F.hll_sketch_agg(c, lg_k).alias(_sketch(n)) for n, c in columns.items()])


def roll_up(sketches: DataFrame, keys: list, names: list[str]) -> DataFrame:
    """Sketches of coarser groups, from sketches alone (again a table that rolls up)."""
    return sketches.groupBy(*keys).agg(*[F.hll_union_agg(_sketch(n)).alias(_sketch(n)) for n in names])


def with_estimates(sketches: DataFrame, names: list[str]) -> DataFrame:
    """The estimated distinct count of every sketch, under its name; sketches go."""
    return (sketches.withColumns({n: F.hll_sketch_estimate(_sketch(n)) for n in names})
                    .drop(*[_sketch(n) for n in names]))


def within_bound(estimate: Column, exact: Column, lg_k: int = LG_K) -> Column:
    """Whether an estimate keeps the sketch's error bound (at least one half, for rounding)."""
    bound = F.greatest(F.lit(0.5), F.lit(SIGMAS * 1.04 / 2 ** (lg_k / 2)) * exact)
    return F.abs(estimate - exact) <= bound
