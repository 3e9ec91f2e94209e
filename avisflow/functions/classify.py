"""CASE classifiers of the enriched, fact and dimension models (CAS-3..10, NLP-3)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from avisflow.functions.numeric import flag

# ---------------------------------------------------------------------------
# Thresholds and labels of the reference models.
SENTIMENT_THRESHOLD = 0.05          # compound >= +t positive, <= -t negative
HIGH_RATING = 4                     # rating >= 4 -> positive / high
LOW_RATING = 2                      # rating <= 2 -> negative / low
NEUTRAL_RATING = 3                  # neutral sentiment is coherent only at exactly 3
STRONG_SENTIMENT = 0.5              # |vader| > 0.5
DETAILED_REVIEW = 100               # text_length > 100
URGENT_PRIORITY = "priorite_haute"
# data_quality_score: (score, min sentiment confidence, min topic confidence or None, min length)
QUALITY_TIERS = [
    (5, 0.6, 0.3, 50),
    (4, 0.4, 0.2, 30),
    (3, 0.3, None, 20),
    (2, 0.2, None, 10),
]
PERFORMANCE_TIERS = [(4.0, "Excellent"), (3.5, "Bon"), (3.0, "Moyen")]
PERFORMANCE_DEFAULT = "Faible"
SIZE_TIERS = [(100, "Grande banque"), (50, "Banque moyenne")]
SIZE_DEFAULT = "Petite banque"
# ---------------------------------------------------------------------------


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentiment_label(compound="vader_compound") -> Column:
    c = _as_col(compound)
    return (F.when(c >= SENTIMENT_THRESHOLD, "positive")
             .when(c <= -SENTIMENT_THRESHOLD, "negative")
             .otherwise("neutral"))


def rating_sentiment(rating="rating") -> Column:
    r = _as_col(rating)
    return (F.when(r >= HIGH_RATING, "positive")
             .when(r <= LOW_RATING, "negative")
             .otherwise("neutral"))


def sentiment_rating_consistency(sentiment="sentiment", rating="rating") -> Column:
    s, r = _as_col(sentiment), _as_col(rating)
    coherent = (((s == "positive") & (r >= HIGH_RATING))
                | ((s == "negative") & (r <= LOW_RATING))
                | ((s == "neutral") & (r == NEUTRAL_RATING)))
    return F.when(coherent, "coherent").otherwise("incoherent")


def agency_type(agency="agency") -> Column:
    """CAS-5, kept as written: the 'Centre Commercial' branch is unreachable."""
    a = _as_col(agency)
    return (F.when(a.like("%Centre%") | a.like("%centre%"), "centre-ville")
             .when(a.like("%Mall%") | a.like("%Centre Commercial%"), "centre-commercial")
             .otherwise("standard"))


def data_quality_score(conf="sentiment_confidence", topic_conf="topic_confidence_score",
                       length="text_length") -> Column:
    c, t, n = _as_col(conf), _as_col(topic_conf), _as_col(length)
    expr = None
    for score, min_conf, min_topic, min_len in QUALITY_TIERS:
        cond = (c > min_conf) & (n > min_len)
        if min_topic is not None:
            cond = cond & (t > min_topic)
        expr = F.when(cond, score) if expr is None else expr.when(cond, score)
    return expr.otherwise(1)


def performance_category(avg_rating="avg_rating") -> Column:
    a = _as_col(avg_rating)
    expr = None
    for bound, label in PERFORMANCE_TIERS:
        expr = F.when(a >= bound, label) if expr is None else expr.when(a >= bound, label)
    return expr.otherwise(PERFORMANCE_DEFAULT)


def size_category(total="total_reviews") -> Column:
    t = _as_col(total)
    expr = None
    for bound, label in SIZE_TIERS:
        expr = F.when(t >= bound, label) if expr is None else expr.when(t >= bound, label)
    return expr.otherwise(SIZE_DEFAULT)


def review_flags() -> dict[str, Column]:
    """CAS-6/CAS-8 0/1 indicators of the fact table."""
    s, r = F.col("sentiment"), F.col("rating")
    return {
        "is_positive": flag(s == "positive"),
        "is_negative": flag(s == "negative"),
        "is_neutral": flag(s == "neutral"),
        "is_high_rating": flag(r >= HIGH_RATING),
        "is_low_rating": flag(r <= LOW_RATING),
        "is_coherent": flag(F.col("sentiment_rating_consistency") == "coherent"),
        "needs_urgent_action": flag(F.col("action_priority") == URGENT_PRIORITY),
    }
