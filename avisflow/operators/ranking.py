"""WIN-5: RANK() over a whole result without a single-task window.

``rank() over (order by k)`` with no partition moves every row to one task. Here:

1. count rows per distinct key (partial aggregation: a hot key collapses map-side);
2. give each distinct key a bucket by quantile cut points of the distinct keys (equal keys share
   a bucket and buckets keep key order; the cut points are checkpointed, so recomputing a lost
   partition gives the same answer);
3. the rows before a bucket come from a window over at most ``buckets + 2`` bucket totals;
   the rows before a key inside its bucket from a window partitioned by bucket;
4. rank = rows before + 1, written once and joined back to the input on the key (null-safe):
   broadcast while small, else a plain join whose hot keys AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from avisflow.operators.joins import broadcast_if_small
from avisflow.session import checkpointed, materialized_table

DEFAULT_BUCKETS = 64


KEY_TYPE = "decimal(38,6)"


def global_ranks(df: DataFrame, keys: dict[str, Column], descending: bool = True, nulls_first: bool = True,
                 buckets: int | None = None) -> DataFrame:
    """Add one RANK() column per entry of ``keys`` (name -> key expression), all computed in
    one pass: the keys are stacked as (rank name, key) rows and every step below is grouped or
    partitioned by the rank name as well. ``buckets`` defaults to the session's shuffle
    partitions (at least 64), so the per-bucket sorts spread over the cluster."""
    if buckets is None:
        buckets = max(DEFAULT_BUCKETS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    buckets = max(2, buckets)
    names = list(keys)
    kcols = {n: f"__rk_{n}" for n in names}
    keyed = df.withColumns({kcols[n]: keys[n] for n in names})
    types = {keyed.schema[kcols[n]].dataType.simpleString() for n in names}
    if len(types) > 1:  # stacked keys need one type; decimal(38,6) holds counts and 6-place averages
        keyed = keyed.withColumns({kcols[n]: F.col(kcols[n]).cast(KEY_TYPE) for n in names})
    stacked = keyed.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rk"), F.col(kcols[n]).alias("v"))
                                               for n in names])).alias("s")).select("s.rk", "s.v")
    counts = checkpointed(stacked.groupBy("rk", "v").agg(F.count(F.lit(1)).alias("__n")))
    # cut points at quantiles of the distinct keys: one giant key cannot push the others together
    at = F.array(*[F.lit((i + 1) / buckets) for i in range(buckets - 1)])
    cuts = checkpointed(counts.where("v is not null").groupBy("rk").agg(
        F.array_distinct(F.percentile_approx("v", at, F.lit(10 * buckets))).alias("__cuts")))
    below = F.size(F.filter("__cuts", lambda c: c < F.col("v")))
    pos = F.lit(buckets) - below if descending else below
    null_bucket = -1 if nulls_first else buckets + 1
    # one row per rank name: bounded by the number of ranks requested
    bucketed = (counts.join(F.broadcast(cuts), "rk", "left")
                .withColumn("__b", F.when(F.col("v").isNull(), F.lit(null_bucket)).otherwise(pos)).drop("__cuts"))
    totals = bucketed.groupBy("rk", "__b").agg(F.sum("__n").alias("__bn"))
    before_bucket = F.sum("__bn").over(
        Window.partitionBy("rk").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    # at most (buckets + 2) rows per rank name
    offsets = F.broadcast(totals.select("rk", "__b", F.coalesce(before_bucket, F.lit(0)).alias("__off")))
    order = F.col("v").desc() if descending else F.col("v").asc()
    before_key = F.sum("__n").over(
        Window.partitionBy("rk", "__b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    # computed once at the grain of distinct keys, then looked up for each rank
    ranks = materialized_table(bucketed.withColumn("__before", F.coalesce(before_key, F.lit(0)))
             .join(offsets, ["rk", "__b"])
             .select("rk", "v", (F.col("__off") + F.col("__before") + 1).cast("int").alias("__rank")), "ranks")
    out = keyed
    for n in names:
        r = ranks.where(F.col("rk") == n).select(F.col("v").alias(f"__v_{n}"), F.col("__rank").alias(n))
        out = out.join(broadcast_if_small(r), out[kcols[n]].eqNullSafe(r[f"__v_{n}"]), "inner").drop(f"__v_{n}")
    return out.drop(*kcols.values())


def global_rank(df: DataFrame, key: Column, name: str, descending: bool = True,
                nulls_first: bool = True, buckets: int | None = None) -> DataFrame:
    """Add column ``name`` = RANK() OVER (ORDER BY key [DESC] NULLS FIRST|LAST)."""
    return global_ranks(df, {name: key}, descending, nulls_first, buckets)
