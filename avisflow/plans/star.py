"""M-3..M-7: the star schema (one review fact, bank/branch/location/sentiment dimensions).

Keys are content hashes on both sides (fact and dimension hash the same columns), so every
fact row finds its dimension row and keys never depend on row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from avisflow.functions import classify
from avisflow.functions.keys import surrogate_key
from avisflow.functions.numeric import flag, percent, pg_round
from avisflow.operators.shares import partition_aggregate

BANK_KEY = ("bank",)
BRANCH_KEY = ("agency", "bank", "location")
LOCATION_KEY = ("location",)
SENTIMENT_KEY = ("bank", "sentiment")


def fact_reviews(enriched: DataFrame) -> DataFrame:
    base = enriched.where(F.col("review_id").isNotNull()).select(
        "review_id",
        surrogate_key(*BANK_KEY).alias("bank_key"),
        surrogate_key(*BRANCH_KEY).alias("branch_key"),
        surrogate_key(*LOCATION_KEY).alias("location_key"),
        surrogate_key(*SENTIMENT_KEY).alias("sentiment_key"),
        "author", "review_date", "detected_language", "review_quality",
        "sentiment_rating_consistency", "topic_category",
        F.col("rating").alias("review_rating"),
        "text_length",
        F.col("vader_compound").alias("vader_sentiment_score"),
        F.col("textblob_polarity").alias("textblob_sentiment_score"),
        F.col("confidence").alias("sentiment_confidence"),
        F.coalesce(F.col("topic_confidence"), F.lit(0.0)).alias("topic_confidence_score"),
        *[c.alias(n) for n, c in classify.review_flags().items()],
    )
    return base.withColumns({
        "data_quality_score": classify.data_quality_score(),
        "is_strong_sentiment": flag(F.abs("vader_sentiment_score") > classify.STRONG_SENTIMENT),
        "is_detailed_review": flag(F.col("text_length") > classify.DETAILED_REVIEW),
    })


def _bank_measures():
    s = F.col("sentiment")
    return {
        "total_reviews": F.count(F.lit(1)),
        "avg_rating": pg_round(F.avg("rating"), 2),
        "positive_reviews": F.count(F.when(s == "positive", 1)),
        "negative_reviews": F.count(F.when(s == "negative", 1)),
        "neutral_reviews": F.count(F.when(s == "neutral", 1)),
    }


def _bank_output(df: DataFrame) -> DataFrame:
    return df.select(
        surrogate_key("bank").alias("bank_key"),
        F.col("bank").alias("bank_name"),
        "total_reviews", "avg_rating", "positive_reviews", "negative_reviews", "neutral_reviews",
        percent(F.col("positive_reviews"), F.col("total_reviews"), 1).alias("positive_percentage"),
        classify.performance_category("avg_rating").alias("performance_category"),
        classify.size_category("total_reviews").alias("size_category"),
    )


def dim_bank(enriched: DataFrame) -> DataFrame:
    """M-4 / AGG-17: one grouped aggregate per bank."""
    m = _bank_measures()
    agg = enriched.where(F.col("bank").isNotNull()).groupBy("bank").agg(*[e.alias(n) for n, e in m.items()])
    return _bank_output(agg)


def dim_bank_window_form(enriched: DataFrame) -> DataFrame:
    """WIN-4: the reference's shape — per-bank aggregates attached to every review, then
    DISTINCT — with the partition aggregates computed skew-safely (aggregate + join back)."""
    rows = enriched.where(F.col("bank").isNotNull()).select("bank", "rating", "sentiment")
    with_aggs = partition_aggregate(rows, ["bank"], _bank_measures())
    return _bank_output(with_aggs.drop("rating", "sentiment").distinct())


def dim_branch(stg: DataFrame) -> DataFrame:
    agg = (stg.where(F.col("agency").isNotNull())
              .groupBy(*BRANCH_KEY)
              .agg(F.count(F.lit(1)).alias("total_reviews"),
                   F.avg("rating").alias("avg_rating"),
                   F.min("review_date").alias("first_review_date"),
                   F.max("review_date").alias("last_review_date")))
    return agg.select(surrogate_key(*BRANCH_KEY).alias("branch_key"), *BRANCH_KEY, "total_reviews",
                      pg_round("avg_rating", 2).alias("avg_rating"), "first_review_date", "last_review_date")


def dim_location(stg: DataFrame) -> DataFrame:
    """M-6; the correlated per-location COUNT(DISTINCT bank) folds into the same aggregate. Reviews
    are first rolled up to (location, agency, bank), so the distinct counts expand few rows."""
    rolled = (stg.where(F.col("location").isNotNull())
                 .groupBy("location", "agency", "bank")
                 .agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("rating_sum"), F.count("rating").alias("rating_n"),
                      F.min("review_date").alias("first_date"), F.max("review_date").alias("last_date")))
    agg = (rolled.groupBy("location")
                 .agg(F.sum("n").alias("total_reviews"),
                      (F.sum("rating_sum") / F.sum("rating_n")).alias("avg_rating"),
                      F.countDistinct("agency").alias("unique_agencies"),
                      F.countDistinct("bank").alias("unique_banks"),
                      F.min("first_date").alias("first_review_date"),
                      F.max("last_date").alias("last_review_date")))
    return agg.select(surrogate_key(*LOCATION_KEY).alias("location_key"), "location", "total_reviews",
                      pg_round("avg_rating", 2).alias("avg_rating"), "unique_agencies", "unique_banks",
                      "first_review_date", "last_review_date")


def dim_sentiment(enriched: DataFrame) -> DataFrame:
    agg = (enriched.where(F.col("sentiment").isNotNull())
                   .groupBy(*SENTIMENT_KEY)
                   .agg(F.count(F.lit(1)).alias("total_reviews"),
                        F.avg("rating").alias("avg_rating"),
                        F.avg("vader_compound").alias("avg_vader_compound"),
                        F.min("review_date").alias("first_review_date"),
                        F.max("review_date").alias("last_review_date")))
    return agg.select(surrogate_key(*SENTIMENT_KEY).alias("sentiment_key"), *SENTIMENT_KEY,
                      pg_round("avg_vader_compound", 3).alias("avg_vader_compound"),
                      pg_round("avg_rating", 2).alias("avg_rating"),
                      "total_reviews", "first_review_date", "last_review_date")
