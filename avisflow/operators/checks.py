"""Declarative column tests (DQ-1..3): unique, not_null, relationships.

Each returns the failing rows' count as a one-row DataFrame
``(test, model, column_name, failures)`` so results can be unioned into one report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _report(test: str, model: str, column: str, failures_df: DataFrame) -> DataFrame:
    return failures_df.agg(F.count(F.lit(1)).cast("long").alias("failures")).select(
        F.lit(test).alias("test"), F.lit(model).alias("model"), F.lit(column).alias("column_name"), "failures")


def dq_unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Distinct non-null values that occur more than once."""
    dups = df.where(F.col(column).isNotNull()).groupBy(column).count().where(F.col("count") > 1)
    return _report("unique", model, column, dups)


def dq_not_null(df: DataFrame, model: str, column: str) -> DataFrame:
    return _report("not_null", model, column, df.where(F.col(column).isNull()))


def dq_relationships(child: DataFrame, model: str, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child values (non-null) without a parent row."""
    p = parent.select(F.col(field).alias("__parent")).distinct()
    orphans = (child.where(F.col(column).isNotNull())
                    .join(p, F.col(column) == F.col("__parent"), "left_anti"))
    return _report("relationships", model, column, orphans)
