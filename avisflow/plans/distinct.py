"""AGG-2 that merges: sketches of branches and authors per bank, place and month (M-6, M-9)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from avisflow.functions.dates import is_iso_date, iso_to_date, month_bucket, quarter_bucket
from avisflow.functions.keys import surrogate_key
from avisflow.operators.sketches import distinct_sketches, roll_up, with_estimates, within_bound

COUNTED = ("branches", "authors")


def _dated(enriched: DataFrame) -> DataFrame:
    return (enriched.where(F.col("review_date").isNotNull() & is_iso_date("review_date"))
                    .select("bank", "location", surrogate_key("agency", "bank", "location").alias("branches"),
                            F.col("author").alias("authors"), month_bucket(iso_to_date("review_date")).alias("review_month")))


def monthly_sketches(enriched: DataFrame) -> DataFrame:
    """The table to keep: one row per bank, place and month. A new month adds rows, nothing is redone."""
    return distinct_sketches(_dated(enriched), ["bank", "location", "review_month"], {n: F.col(n) for n in COUNTED})


GRAINS = {"bank_quarter": ("bank", "period"), "location": ("location",), "bank": ("bank",), "all": ()}


def rolled_up(monthly: DataFrame) -> DataFrame:
    """Estimated distinct branches and authors at every grain of GRAINS, from the monthly sketches."""
    m = monthly.withColumn("period", quarter_bucket(F.col("review_month")))
    return reduce(DataFrame.unionByName, [
        _at_grain(with_estimates(roll_up(m, list(keys), list(COUNTED)), list(COUNTED)), grain) for grain, keys in GRAINS.items()])


def _exact(enriched: DataFrame) -> DataFrame:
    """The same from the reviews, exactly: the distinct values per group first, hot groups in parts."""
    d = _dated(enriched).withColumn("period", quarter_bucket(F.col("review_month")))
    return reduce(DataFrame.unionByName, [
        _at_grain(d.groupBy(*keys).agg(*[F.countDistinct(n).alias(n) for n in COUNTED]), grain) for grain, keys in GRAINS.items()])


def _at_grain(df: DataFrame, grain: str) -> DataFrame:
    """The rows under common columns; a global grain of no review at all has no row."""
    keys = GRAINS[grain]
    columns = [(F.col(c) if c in keys else F.lit(None)).cast(t).alias(c)
               for c, t in (("bank", "string"), ("location", "string"), ("period", "date"))]
    out = df.select(F.lit(grain).alias("grain"), *columns, *COUNTED)
    return out if keys else out.where(F.col(COUNTED[0]).isNotNull() & (F.greatest(*COUNTED) > 0))


def checked(monthly: DataFrame, enriched: DataFrame) -> DataFrame:
    """Exact counts at every grain, and whether the rolled-up sketches keep their error bound."""
    keys = ("grain", "bank", "location", "period")
    exact = _exact(enriched).alias("e")
    rolled = rolled_up(monthly).alias("s")
    same = reduce(lambda a, b: a & b, [F.col(f"e.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    return exact.join(rolled, same, "full").select(
        *[F.coalesce(f"e.{k}", f"s.{k}").alias(k) for k in keys], *[F.col(f"e.{n}").alias(n) for n in COUNTED],
        *[F.coalesce(within_bound(F.col(f"s.{n}"), F.col(f"e.{n}")), F.lit(False)).alias(f"{n}_within") for n in COUNTED])
