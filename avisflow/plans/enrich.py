"""M-2 reviews_enriched: staged reviews + sentiment + topics + business annotations.

All three joins are on ``review_id``; Spark shuffles each side once by that key and the
left side's partitioning carries through the chain of joins (no re-shuffle between them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from avisflow.functions import classify

SENTIMENT_COLUMNS = ("sentiment", "vader_compound", "textblob_polarity", "confidence")
TOPIC_COLUMNS = ("dominant_topic", "topic_category", "topic_keywords", "topic_confidence")
ANNOTATION_COLUMNS = ("feedback_category", "business_segment", "review_quality", "action_priority")


def _with_nulls(df: DataFrame, cols, types) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast(t) for c, t in zip(cols, types)})


def reviews_enriched(stg: DataFrame, sentiment: DataFrame, topics: DataFrame | None = None,
                     annotations: DataFrame | None = None) -> DataFrame:
    df = stg.join(sentiment.select("review_id", *SENTIMENT_COLUMNS), "review_id", "left")
    if topics is not None:
        df = df.join(topics.select("review_id", *TOPIC_COLUMNS), "review_id", "left")
    else:
        df = _with_nulls(df, TOPIC_COLUMNS, ("int", "string", "string", "double"))
    if annotations is not None:
        df = df.join(annotations.select("review_id", *ANNOTATION_COLUMNS), "review_id", "left")
    else:
        df = _with_nulls(df, ANNOTATION_COLUMNS, ("string",) * 4)
    return df.withColumns({
        "rating_sentiment": classify.rating_sentiment("rating"),
        "sentiment_rating_consistency": classify.sentiment_rating_consistency("sentiment", "rating"),
        "agency_type": classify.agency_type("agency"),
    })
