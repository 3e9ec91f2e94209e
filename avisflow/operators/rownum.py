"""WIN-1 on request: a dense ROW_NUMBER() over a global order, without a single-task window.

1. range-partition on the order (which must be total: end it with a unique column, so a hot
   leading key is still split across partitions) and sort inside partitions;
2. checkpoint the rows with Spark's monotonic id, which holds the partition and the place inside
   it: range bounds come from sampling, so the assignment is fixed once; the rows are not
   shuffled again;
3. rows before each partition = running sum over the per-partition counts (one row per
   partition: bounded by the partition count);
4. row number = offset of the partition + place inside it + 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from avisflow.session import checkpointed


def dense_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_id",
                     partitions: int | None = None) -> DataFrame:
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged = checkpointed(placed.withColumn("__mid", F.monotonically_increasing_id()))
    part, local = F.shiftright("__mid", 33).alias("__pid"), F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranged.select(part).groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select("__pid", F.coalesce(F.sum("__n").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    return (ranged.withColumn("__pid", part)
                  .join(F.broadcast(offsets), "__pid")  # one row per partition
                  .withColumn(name, (F.col("__off") + local + 1).cast("long"))
                  .drop("__pid", "__mid", "__off"))
