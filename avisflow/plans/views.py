"""M-8..M-11: reporting views over the star schema.

Dimension lookups are equi-joins on hash keys: broadcast where the dimension's table is measured
small, plain joins (which AQE may still turn or split) otherwise. Ranks and shares use
the skew-safe operators (no window without a partition at scale).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from avisflow.functions.dates import DEFAULT_AS_OF, is_iso_date, iso_to_date, month_bucket, months_back, quarter_bucket
from avisflow.functions.numeric import percent, pg_round, rank_key
from avisflow.operators.joins import broadcast_if_small
from avisflow.operators.ranking import global_ranks
from avisflow.operators.shares import share_within
from avisflow.session import checkpointed

MIN_BRANCH_REVIEWS = 3
TOPIC_MIN_CONFIDENCE = 0.6


def _lookup(dim: DataFrame, *columns) -> DataFrame:
    """The columns a view takes from a dimension; broadcast if the table is measured small, so the
    fact is not shuffled onto the few keys of banks or locations."""
    return broadcast_if_small(dim.select(*columns))


def _star(fact: DataFrame, dim_bank: DataFrame, dim_branch: DataFrame, dim_location: DataFrame,
          how: str = "inner") -> DataFrame:
    return (fact
            .join(_lookup(dim_bank, "bank_key", "bank_name"), "bank_key", how)
            .join(_lookup(dim_branch, "branch_key", F.col("agency").alias("branch_name")), "branch_key", how)
            .join(_lookup(dim_location, "location_key", F.col("location").alias("location_name")), "location_key", how))


def _dated(fact: DataFrame) -> DataFrame:
    """FLT-3 + DAT-1: ISO-dated facts with the parsed date computed once."""
    return (fact.where(F.col("review_date").isNotNull() & is_iso_date("review_date"))
                .withColumn("review_day", iso_to_date("review_date")))


def _review_measures() -> dict:
    r = F.col("review_rating")
    return {
        "avg_rating": pg_round(F.avg(r), 2),
        "avg_vader": pg_round(F.avg("vader_sentiment_score"), 3),
        "avg_textblob": pg_round(F.avg("textblob_sentiment_score"), 3),
        "avg_confidence": pg_round(F.avg("sentiment_confidence"), 3),
    }


def _rating_histogram() -> list:
    r = F.col("review_rating")
    return [F.count_if(r == v).alias(f"rating_{v}_count") for v in (5, 4, 3, 2, 1)]


def branch_performance(fact: DataFrame, dim_bank: DataFrame, dim_branch: DataFrame,
                       dim_location: DataFrame) -> DataFrame:
    star = _star(_dated(fact), dim_bank, dim_branch, dim_location)
    n = F.count("review_id")
    m = _review_measures()
    agg = (star.groupBy("bank_name", "branch_name", "location_name")
               .agg(n.alias("total_reviews"),
                    m["avg_rating"].alias("avg_rating"),
                    m["avg_vader"].alias("avg_vader_sentiment"),
                    m["avg_textblob"].alias("avg_textblob_sentiment"),
                    m["avg_confidence"].alias("avg_confidence"),
                    F.sum("is_positive").alias("positive_reviews"),
                    F.sum("is_negative").alias("negative_reviews"),
                    F.sum("is_neutral").alias("neutral_reviews"),
                    pg_round(F.avg("data_quality_score"), 2).alias("avg_quality_score"),
                    pg_round(F.avg("text_length"), 1).alias("avg_text_length"),
                    F.sum("is_detailed_review").alias("detailed_reviews_count"),
                    F.sum("is_strong_sentiment").alias("strong_sentiment_count"),
                    F.sum("needs_urgent_action").alias("urgent_action_needed"),
                    F.count_if(F.col("is_coherent") == 0).alias("incoherent_reviews"),
                    *_rating_histogram(),
                    rank_key(F.avg("review_rating")).alias("__avg_rating_key"),
                    rank_key(F.avg("vader_sentiment_score")).alias("__avg_vader_key"),
                    F.min("review_day").alias("first_review_date"),
                    F.max("review_day").alias("last_review_date"))
               .where(F.col("total_reviews") >= MIN_BRANCH_REVIEWS))
    agg = agg.withColumns({
        "positive_percentage": percent(F.col("positive_reviews"), F.col("total_reviews"), 2),
        "negative_percentage": percent(F.col("negative_reviews"), F.col("total_reviews"), 2),
        "neutral_percentage": percent(F.col("neutral_reviews"), F.col("total_reviews"), 2),
    })
    # branch-grain aggregate, read by the rank pass and the join back: compute it once
    agg = checkpointed(agg)
    agg = global_ranks(agg, {"rating_rank": F.col("__avg_rating_key"), "sentiment_rank": F.col("__avg_vader_key"),
                             "volume_rank": F.col("total_reviews")})
    cols = ["bank_name", "branch_name", "location_name", "total_reviews", "avg_rating", "avg_vader_sentiment",
            "avg_textblob_sentiment", "avg_confidence", "positive_reviews", "negative_reviews", "neutral_reviews",
            "positive_percentage", "negative_percentage", "neutral_percentage", "avg_quality_score",
            "avg_text_length", "detailed_reviews_count", "strong_sentiment_count", "urgent_action_needed",
            "incoherent_reviews", "rating_5_count", "rating_4_count", "rating_3_count", "rating_2_count",
            "rating_1_count", "rating_rank", "sentiment_rank", "volume_rank", "first_review_date",
            "last_review_date"]
    return agg.select(*cols).orderBy(F.col("avg_rating").desc_nulls_first(), F.col("total_reviews").desc_nulls_first())


def customer_insights(fact: DataFrame, dim_bank: DataFrame, dim_branch: DataFrame, dim_location: DataFrame,
                      as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    dated = _dated(fact).where(F.col("review_day") >= months_back(as_of, 24))
    star = (dated.join(_lookup(dim_bank, "bank_key", "bank_name"), "bank_key")
                 .join(_lookup(dim_branch, "branch_key"), "branch_key")
                 .join(_lookup(dim_location, "location_key"), "location_key")
                 .withColumn("review_quarter", quarter_bucket(F.col("review_day"))))
    r = F.col("review_rating")
    averaged = {"avg_rating": ("review_rating", 2), "avg_vader_sentiment": ("vader_sentiment_score", 3),
                "avg_textblob_sentiment": ("textblob_sentiment_score", 3), "avg_confidence": ("sentiment_confidence", 3),
                "avg_quality_score": ("data_quality_score", 2), "avg_text_length": ("text_length", 1)}
    summed = {"positive_count": F.sum("is_positive"), "negative_count": F.sum("is_negative"),
              "neutral_count": F.sum("is_neutral"), "total_reviews": F.count("review_id"),
              "detailed_reviews": F.sum("is_detailed_review"), "urgent_reviews": F.sum("needs_urgent_action"),
              "__nps_diff": F.count_if(r >= 4) - F.count_if(r <= 2),
              **{f"rating_{v}_count": F.count_if(r == v) for v in (5, 4, 3, 2, 1)}}
    # rolled up to the places first: the distinct counts then expand place rows, not reviews
    places = (star.groupBy("review_quarter", "bank_name", "branch_key", "location_key")
                  .agg(*[e.alias(n) for n, e in summed.items()],
                       *[F.sum(c).alias(f"__s_{n}") for n, (c, _) in averaged.items()],
                       *[F.count(c).alias(f"__n_{n}") for n, (c, _) in averaged.items()]))
    agg = (places.groupBy("review_quarter", "bank_name")
                 .agg(F.countDistinct("branch_key").alias("active_branches"),
                      F.countDistinct("location_key").alias("locations_covered"),
                      *[F.sum(n).alias(n) for n in summed],
                      *[pg_round(F.sum(f"__s_{n}") / F.nullif(F.sum(f"__n_{n}"), F.lit(0)), d).alias(n)
                        for n, (_, d) in averaged.items()]))
    # one partition per bank holds at most one row per quarter of the 24-month window
    w = Window.partitionBy("bank_name").orderBy(F.col("review_quarter").asc_nulls_last())
    agg = agg.withColumns({
        "positive_rate": percent(F.col("positive_count"), F.col("total_reviews"), 2),
        "negative_rate": percent(F.col("negative_count"), F.col("total_reviews"), 2),
        "nps_score": percent(F.col("__nps_diff"), F.col("total_reviews"), 2),
        "prev_quarter_rating": F.lag("avg_rating", 1).over(w),
        "prev_quarter_volume": F.lag("total_reviews", 1).over(w),
    })
    cols = ["review_quarter", "bank_name", "total_reviews", "active_branches", "locations_covered", "avg_rating",
            "avg_vader_sentiment", "avg_textblob_sentiment", "avg_confidence", "positive_count", "negative_count",
            "neutral_count", "positive_rate", "negative_rate", "rating_5_count", "rating_4_count", "rating_3_count",
            "rating_2_count", "rating_1_count", "nps_score", "avg_quality_score", "avg_text_length",
            "detailed_reviews", "urgent_reviews", "prev_quarter_rating", "prev_quarter_volume"]
    return agg.select(*cols).orderBy(F.col("review_quarter").desc_nulls_first(), F.col("bank_name").asc_nulls_last())


def sentiment_trends(fact: DataFrame, dim_bank: DataFrame, dim_branch: DataFrame, dim_location: DataFrame,
                     dim_sentiment: DataFrame, as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    dated = _dated(fact).where(F.col("review_day") >= months_back(as_of, 12))
    star = (_star(dated, dim_bank, dim_branch, dim_location)
            .join(_lookup(dim_sentiment, "sentiment_key", F.col("sentiment").alias("sentiment_label")), "sentiment_key")
            .withColumn("review_month", month_bucket(F.col("review_day"))))
    m = _review_measures()
    agg = (star.groupBy("bank_name", "branch_name", "location_name", "sentiment_label", "review_month")
               .agg(F.count(F.lit(1)).alias("review_count"),
                    m["avg_rating"].alias("avg_rating"),
                    m["avg_vader"].alias("avg_vader_score"),
                    m["avg_textblob"].alias("avg_textblob_score"),
                    m["avg_confidence"].alias("avg_confidence"),
                    pg_round(F.avg("data_quality_score"), 2).alias("avg_quality_score"),
                    F.count_if(F.col("is_coherent") == 1).alias("coherent_reviews"),
                    F.count_if(F.col("needs_urgent_action") == 1).alias("urgent_reviews")))
    agg = share_within(agg, ["bank_name", "review_month"], "review_count", "sentiment_percentage", 2)
    cols = ["bank_name", "branch_name", "location_name", "sentiment_label", "review_month", "review_count",
            "avg_rating", "avg_vader_score", "avg_textblob_score", "avg_confidence", "sentiment_percentage",
            "avg_quality_score", "coherent_reviews", "urgent_reviews"]
    return agg.select(*cols).orderBy(F.col("review_month").desc_nulls_first(), F.col("bank_name").asc_nulls_last(),
                                     F.col("sentiment_percentage").desc_nulls_first())


def topic_analysis(fact: DataFrame, dim_bank: DataFrame, dim_branch: DataFrame, dim_location: DataFrame) -> DataFrame:
    f = (fact.where((F.col("topic_confidence_score") >= TOPIC_MIN_CONFIDENCE)
                    & is_iso_date("review_date") & F.col("topic_category").isNotNull())
             .withColumn("review_day", iso_to_date("review_date")))
    star = _star(f, dim_bank, dim_branch, dim_location, how="left")
    m = _review_measures()
    agg = (star.groupBy("bank_name", "branch_name", "location_name", F.col("topic_category").alias("topic"),
                        "topic_confidence_score")
               .agg(F.count("review_id").alias("topic_occurrence"),
                    m["avg_rating"].alias("avg_rating"),
                    m["avg_vader"].alias("avg_vader_score"),
                    m["avg_textblob"].alias("avg_textblob_score"),
                    m["avg_confidence"].alias("avg_confidence"),
                    pg_round(F.avg("text_length"), 1).alias("avg_text_length"),
                    F.sum("needs_urgent_action").alias("urgent_reviews"),
                    F.min("review_day").alias("first_review_date"),
                    F.max("review_day").alias("last_review_date"),
                    F.count_if(F.col("is_coherent") == 1).alias("coherent_reviews"),
                    F.count_if(F.col("is_coherent") == 0).alias("incoherent_reviews")))
    return agg.orderBy(F.col("topic_occurrence").desc_nulls_first(), F.col("avg_rating").desc_nulls_first())
