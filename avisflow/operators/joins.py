"""Broadcast only what has a size bound; everything else is left to AQE.

* ``one_row``: sides whose size is bounded by construction (a global aggregate) are
  broadcast explicitly; in-repo lookup tables are literal expressions, not joins at all.
* ``broadcast_if_small``: a side read from files is broadcast when the optimizer's size
  estimate is under a limit; above it the join stays a shuffle join, and AQE can still
  switch it to a broadcast after measuring the real size of the shuffled side
  (``spark.sql.adaptive.autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

DEFAULT_LIMIT_BYTES = 8 * 1024 * 1024


def estimated_size_bytes(df: DataFrame) -> int | None:
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # noqa: BLE001 - estimate unavailable (e.g. Spark Connect)
        return None


def broadcast_if_small(df: DataFrame, limit_bytes: int = DEFAULT_LIMIT_BYTES) -> DataFrame:
    size = estimated_size_bytes(df)
    if size is not None and size <= limit_bytes:
        return F.broadcast(df)
    return df


def one_row(df: DataFrame) -> DataFrame:
    """Broadcast a global (no grouping key) aggregate: exactly one row."""
    return F.broadcast(df)
