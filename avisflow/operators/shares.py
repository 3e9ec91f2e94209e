"""Shares of a total: WIN-7 (within a partition) and WIN-8 (of the grand total).

Both are written as aggregate + join back instead of ``sum(..).over(partitionBy(..))``:
the totals are pre-aggregated map-side, and the join back is either a broadcast (one-row
grand total) or a shuffle join that AQE can split when one partition key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from avisflow.functions.numeric import percent
from avisflow.operators.joins import broadcast_if_small, one_row
from avisflow.session import materialized_table


def share_of_total(df: DataFrame, value: str, name: str, digits: int = 1) -> DataFrame:
    total = df.agg(F.sum(value).alias("__total"))
    return (df.crossJoin(one_row(total))
              .withColumn(name, percent(F.col(value), F.col("__total"), digits))
              .drop("__total"))


def share_within(df: DataFrame, partition: Sequence[str], value: str, name: str,
                 digits: int = 2) -> DataFrame:
    totals = df.groupBy(*partition).agg(F.sum(value).alias("__total"))
    t = totals.select(*[F.col(c).alias(f"__p_{c}") for c in partition], "__total")
    cond = None
    for c in partition:
        e = df[c].eqNullSafe(t[f"__p_{c}"])
        cond = e if cond is None else cond & e
    return (df.join(t, cond, "inner")
              .withColumn(name, percent(F.col(value), F.col("__total"), digits))
              .drop("__total", *[f"__p_{c}" for c in partition]))


def partition_aggregate(df: DataFrame, partition: Sequence[str], aggs: dict) -> DataFrame:
    """Whole-partition window aggregates (``agg OVER (PARTITION BY ..)``) attached to every
    row, computed as a grouped aggregate joined back (null-safe) on the partition keys."""
    grouped = df.groupBy(*partition).agg(*[expr.alias(n) for n, expr in aggs.items()])
    # written, so its size is known: broadcast while small, else a join whose hot keys AQE splits
    grouped = broadcast_if_small(materialized_table(grouped, "partition_aggregate"))
    g = grouped.select(*[F.col(c).alias(f"__p_{c}") for c in partition], *aggs.keys())
    cond = None
    for c in partition:
        e = df[c].eqNullSafe(g[f"__p_{c}"])
        cond = e if cond is None else cond & e
    return df.join(g, cond, "inner").drop(*[f"__p_{c}" for c in partition])
