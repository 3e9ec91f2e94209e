"""DAT-4: dimensions that keep their audit times over rebuilds."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def merge_dimension(new: DataFrame, old: DataFrame | None, key: str, now: dt.datetime) -> DataFrame:
    """``new`` with created_at and updated_at: full outer join with the earlier version on ``key``.

    A row seen before keeps its created_at, and its updated_at unless a column changed (nulls are
    equal to nulls). Rows that are in ``old`` only stay as they are, since facts may still refer to
    them. Columns that ``old`` lacks count as null there."""
    at = F.lit(now).cast("timestamp")
    columns = new.columns
    if old is None:
        return new.withColumns({"created_at": at, "updated_at": at})
    before = old.select(*[(F.col(c) if c in old.columns else F.lit(None).cast(new.schema[c].dataType)).alias(f"__old_{c}")
                          for c in [*columns, "created_at", "updated_at"]])
    both = new.withColumn("__new", F.lit(True)).join(before, F.col(key) == F.col(f"__old_{key}"), "full_outer")
    is_new, seen = F.col("__new").isNotNull(), F.col("__old_created_at").isNotNull()
    changed = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"__old_{c}")) for c in columns])
    return both.select(*[F.when(is_new, F.col(c)).otherwise(F.col(f"__old_{c}")).alias(c) for c in columns],
                       F.when(seen, F.col("__old_created_at")).otherwise(at).alias("created_at"),
                       F.when(is_new & (~seen | changed), at).otherwise(F.col("__old_updated_at")).alias("updated_at"))
