"""DQ-1..13: column tests on the dimensions and the end-to-end quality report.

All are single aggregations (or unions of one-row aggregations) over the models; grand-total
shares use a broadcast one-row total, never ``OVER ()``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from avisflow.functions.numeric import percent, pg_round
from avisflow.operators import checks
from avisflow.operators.shares import share_of_total
from avisflow.plans.staging import dedup_key, valid_review

# ---------------------------------------------------------------------------
# Alert thresholds and messages of the quality report.
ALERTS = [
    ("sentiment_coverage", 0.9, "Couverture sentiment faible - vérifier la configuration du scoring"),
    ("topic_coverage", 0.7, "Couverture topics faible - ajuster les paramètres LDA"),
    ("coherence_rate", 0.7, "Cohérence sentiment/note faible - vérifier la qualité des données"),
    ("avg_confidence", 0.3, "Confiance sentiment faible - revoir les seuils de classification"),
]
PIVOT_SENTIMENTS = ["negative", "neutral", "positive"]
SAMPLE_KEYWORD_CHARS = 50
# ---------------------------------------------------------------------------


def _union(dfs) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


def dq_unique(dim_bank: DataFrame, dim_branch: DataFrame, dim_sentiment: DataFrame) -> DataFrame:
    return _union([checks.dq_unique(dim_bank, "dim_bank", "bank_key"),
                   checks.dq_unique(dim_branch, "dim_branch", "branch_key"),
                   checks.dq_unique(dim_sentiment, "dim_sentiment", "sentiment_key")])


def dq_not_null(dim_bank: DataFrame, dim_branch: DataFrame, dim_sentiment: DataFrame) -> DataFrame:
    return _union([checks.dq_not_null(dim_bank, "dim_bank", "bank_key"),
                   checks.dq_not_null(dim_bank, "dim_bank", "bank_name"),
                   checks.dq_not_null(dim_branch, "dim_branch", "branch_key"),
                   checks.dq_not_null(dim_branch, "dim_branch", "bank"),
                   checks.dq_not_null(dim_sentiment, "dim_sentiment", "sentiment_key"),
                   checks.dq_not_null(dim_sentiment, "dim_sentiment", "bank")])


def dq_relationships(dim_bank: DataFrame, dim_branch: DataFrame, dim_sentiment: DataFrame) -> DataFrame:
    return _union([checks.dq_relationships(dim_branch, "dim_branch", "bank", dim_bank, "bank_name"),
                   checks.dq_relationships(dim_sentiment, "dim_sentiment", "bank", dim_bank, "bank_name")])


def dedup_rate(staging: DataFrame) -> DataFrame:
    """DQ-4: rows removed between raw and cleaned (filtered rows count as removed too). One pass over
    the raw rows: the cleaned table holds one row per de-duplication key of the valid ones."""
    keyed = staging.select(valid_review().alias("valid"), *dedup_key())
    keys = keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("n"))
    return (keys.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("original_count"), F.count_if("valid").alias("cleaned_count"))
                .withColumn("removed_count", F.col("original_count") - F.col("cleaned_count"))
                .withColumn("removed_percentage", percent(F.col("removed_count"), F.col("original_count"), 1)))


def text_quality_stats(stg: DataFrame) -> DataFrame:
    return stg.groupBy("text_quality").agg(F.count(F.lit(1)).alias("count"),
                                           pg_round(F.avg("text_length"), 0).alias("avg_length"))


def sentiment_stats(enriched: DataFrame) -> DataFrame:
    return (enriched.where(F.col("sentiment").isNotNull()).groupBy("sentiment")
            .agg(F.count(F.lit(1)).alias("count"), pg_round(F.avg("rating"), 2).alias("avg_rating"),
                 pg_round(F.avg("confidence"), 3).alias("avg_confidence"))
            .orderBy(F.col("count").desc()))


def consistency_share(enriched: DataFrame) -> DataFrame:
    counts = (enriched.where(F.col("sentiment").isNotNull())
              .groupBy("sentiment_rating_consistency").agg(F.count(F.lit(1)).alias("count")))
    return share_of_total(counts, "count", "percentage", 1)


def language_share(stg: DataFrame) -> DataFrame:
    counts = stg.groupBy("detected_language").agg(F.count(F.lit(1)).alias("count"))
    return share_of_total(counts, "count", "percentage", 1).orderBy(F.col("count").desc())


def topic_stats(enriched: DataFrame) -> DataFrame:
    """DQ-9 / AGG-11. The distinct keyword strings per category are bounded by topics x
    languages (one string per fitted topic), so the per-category set stays small."""
    sample = F.left(F.col("topic_keywords"), F.lit(SAMPLE_KEYWORD_CHARS))
    return (enriched.where(F.col("topic_category").isNotNull()).groupBy("topic_category")
            .agg(F.count(F.lit(1)).alias("count"),
                 pg_round(F.avg("topic_confidence"), 3).alias("avg_confidence"),
                 F.array_join(F.sort_array(F.collect_set(sample)), " | ").alias("sample_keywords"))
            .orderBy(F.col("count").desc()))


def topic_by_sentiment(enriched: DataFrame) -> DataFrame:
    """DQ-10 / AGG-15: topic x sentiment matrix with fixed pivot values, missing = 0."""
    return (enriched.where(F.col("topic_category").isNotNull() & F.col("sentiment").isNotNull())
            .groupBy("topic_category").pivot("sentiment", PIVOT_SENTIMENTS).count()
            .na.fill(0, PIVOT_SENTIMENTS)
            .orderBy("topic_category"))


def bank_stats(enriched: DataFrame) -> DataFrame:
    s = F.col("sentiment")
    return (enriched.where(s.isNotNull()).groupBy("bank")
            .agg(F.count(F.lit(1)).alias("total_reviews"), pg_round(F.avg("rating"), 2).alias("avg_rating"),
                 F.count(F.when(s == "positive", 1)).alias("positive_reviews"),
                 F.count(F.when(s == "negative", 1)).alias("negative_reviews"))
            .orderBy(F.col("total_reviews").desc()))


def quality_metrics(enriched: DataFrame) -> DataFrame:
    """DQ-12: seven coverage counters in one pass."""
    return enriched.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.count(F.when(F.col("sentiment").isNotNull(), 1)).alias("with_sentiment"),
        F.count(F.when(F.col("topic_category").isNotNull(), 1)).alias("with_topics"),
        F.count(F.when(F.col("detected_language") != "unknown", 1)).alias("with_language"),
        pg_round(F.avg("confidence"), 3).alias("avg_sentiment_confidence"),
        F.count(F.when(F.col("review_quality") == "high", 1)).alias("high_quality"),
        F.count(F.when(F.col("sentiment_rating_consistency") == "coherent", 1)).alias("coherent_reviews"))


def quality_alerts(enriched: DataFrame) -> DataFrame:
    """DQ-13: coverage ratios against thresholds, one row per check."""
    m = quality_metrics(enriched)
    total = F.col("total_reviews").cast("double")
    values = {
        "sentiment_coverage": F.col("with_sentiment") / total,
        "topic_coverage": F.col("with_topics") / total,
        "coherence_rate": F.col("coherent_reviews") / total,
        "avg_confidence": F.col("avg_sentiment_confidence"),
    }
    rows = F.array(*[F.struct(F.lit(name).alias("check_name"), pg_round(values[name], 4).alias("value"),
                              F.lit(threshold).alias("threshold"), F.lit(msg).alias("message"))
                     for name, threshold, msg in ALERTS])
    out = m.select(F.inline(rows))
    # an average confidence of exactly 0 counts as no average at all, as in the reference
    absent = (F.col("check_name") == "avg_confidence") & (F.col("value") == 0)
    triggered = F.coalesce((F.col("value") < F.col("threshold")) & ~absent, F.lit(False))
    return out.select("check_name", "value", "threshold", triggered.alias("triggered"),
                      F.when(triggered, F.col("message")).alias("message"))


def topic_category_distribution(topics: DataFrame) -> DataFrame:
    """AGG-14: value counts of the topic table with their share of all assignments."""
    counts = topics.groupBy("topic_category").agg(F.count(F.lit(1)).alias("count"))
    return share_of_total(counts, "count", "percentage", 1).orderBy(F.col("count").desc())
