from pyspark.sql import functions as F

from avisflow.operators.sketches import distinct_sketches, roll_up, with_estimates, within_bound
from avisflow.plans import distinct
from support import rows

ENRICHED = "bank string, location string, agency string, author string, review_date string"


def test_merged_sketches_keep_the_bound_over_overlapping_groups(spark):
    # 24 months that share half of their authors with the month before
    df = spark.range(240_000).select((F.col("id") / 10_000).cast("int").alias("month"),
                                     (F.col("id") / 10_000).cast("int").alias("m"), (F.col("id") % 10_000).alias("i"))
    df = df.select("month", F.concat_ws("-", F.lit("a"), (F.col("m") * 5000 + F.col("i")).cast("string")).alias("author"))
    monthly = distinct_sketches(df, ["month"], {"authors": F.col("author")})
    year = (monthly.withColumn("year", F.col("month") / 12).withColumn("year", F.col("year").cast("int")))
    for keys, grouped in ((["year"], df.withColumn("year", (F.col("month") / 12).cast("int"))), ([], df)):
        est = with_estimates(roll_up(year, keys, ["authors"]), ["authors"])
        exact = grouped.groupBy(*keys).agg(F.countDistinct("author").alias("exact"))
        both = est.join(exact, keys) if keys else est.crossJoin(exact)
        got = both.select(within_bound(F.col("authors"), F.col("exact")).alias("ok")).collect()
        assert got and all(r.ok for r in got)


def test_rolling_up_twice_equals_rolling_up_once_on_small_counts(spark):
    df = spark.createDataFrame([(m, q, f"x{(m * 7 + i) % 40}") for m in range(12) for q in [m // 3] for i in range(9)],
                               "month int, quarter int, v string")
    monthly = distinct_sketches(df, ["month", "quarter"], {"n": F.col("v")})
    once = with_estimates(roll_up(monthly, [], ["n"]), ["n"])
    twice = with_estimates(roll_up(roll_up(monthly, ["quarter"], ["n"]), [], ["n"]), ["n"])
    assert rows(once) == rows(twice) == [(df.select("v").distinct().count(),)]


def test_nulls_repeats_and_empty_tables(spark):
    data = [("B", "L", "A", None, "2024-01-01"), ("B", "L", "A", None, "2024-02-01"), ("B", None, "A", "x", "2024-05-01"),
            ("B", "L", "A2", "x", "2024-01-09"), (None, "L", "A", "y", "2024-01-01"), ("B", "L", "A3", "z", None),
            ("B", "L", "A3", "z", "il y a 2 mois")]
    df = spark.createDataFrame(data, ENRICHED)
    out = {(r.grain, r.bank, r.location, str(r.period)): r for r in distinct.checked(distinct.monthly_sketches(df), df).collect()}
    first = out[("bank_quarter", "B", None, "2024-01-01")]
    assert (first.branches, first.authors) == (2, 1)
    assert (out[("location", None, None, "None")].branches, out[("all", None, None, "None")].authors) == (1, 2)
    assert len(out) == 3 + 2 + 2 + 1 and all(r.branches_within and r.authors_within for r in out.values())
    assert distinct.checked(distinct.monthly_sketches(df.limit(0)), df.limit(0)).count() == 0
