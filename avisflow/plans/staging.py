"""M-1 stg_reviews: filter valid reviews, derive text columns, keep the latest copy."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from avisflow.functions import keys, text
from avisflow.operators.dedup import latest_per_key

# The cleaned text enters the dedup key as its SHA-256: the shuffle before the dedup window then
# carries 64 characters instead of the text, consumers that never read the text (fact, dimensions,
# views) let Catalyst prune it out of that shuffle, and texts that users could craft to collide
# under a weaker hash stay apart.
DEDUP_KEYS = ("bank", "agency", "author", "__clean_hash")


def valid_reviews(staging: DataFrame) -> DataFrame:
    """FLT-1: non-blank text and a rating between 1 and 5."""
    return staging.where(valid_review())


def valid_review():
    t, r = F.col("review_text"), F.col("rating")
    return F.coalesce((F.trim(t) != "") & r.between(1, 5), F.lit(False))


def dedup_key():
    """The de-duplication key of a raw row: see DEDUP_KEYS."""
    return [F.col(c) for c in DEDUP_KEYS[:-1]] + [F.sha2(text.clean_text("review_text"), 256).alias(DEDUP_KEYS[-1])]


def cleaned_reviews(staging: DataFrame) -> DataFrame:
    """Valid rows with id and derived text columns (before de-duplication)."""
    return (valid_reviews(staging)
            .withColumns({
                "review_id": keys.review_id(),
                "clean_text": text.clean_text("review_text"),
                "detected_language": text.detected_language("review_text"),
                "text_length": F.length("review_text"),
                "text_quality": text.text_quality("review_text"),
            }))


def dedup_order():
    """Latest date first, undated copies before all (PostgreSQL DESC puts nulls first); ties by
    shorter raw text, then by id and by every column the id leaves out: rows that still tie are
    equal in all columns, so the survivor never depends on row order."""
    rest = [F.col(c).asc_nulls_last() for c in ("rating", "url", "location", "doc_id")]
    return [F.col("review_date").desc_nulls_first(), F.col("text_length").asc(), F.col("review_id").asc(), *rest]


def stg_reviews(staging: DataFrame, add=None, drop: tuple = ()) -> DataFrame:
    """``add``: columns computed from the cleaned rows before de-duplication, where the texts are read,
    so that texts named in ``drop`` need not move to the window. Such columns must follow from the
    cleaned text alone: rows of one key then share them."""
    if "doc_id" not in staging.columns:  # raw reviews that no document stands behind
        staging = staging.withColumn("doc_id", F.lit(None).cast("long"))
    cleaned = cleaned_reviews(staging).withColumn("__clean_hash", F.sha2("clean_text", 256))
    if add:
        cleaned = add(cleaned)
    df = latest_per_key(cleaned.drop(*drop), DEDUP_KEYS, dedup_order()).drop("__clean_hash")
    first = ["review_id"]
    return df.select(*first, *[c for c in df.columns if c not in first])
