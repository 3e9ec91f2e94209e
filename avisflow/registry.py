"""Query registry: name -> callable(spark, sf_dir) -> DataFrame (one per inventory item)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from avisflow.functions.dates import is_iso_date
from avisflow.plans import collect, distinct, quality, sentiment, sentiment_rules, star, topic_model, topics
from avisflow.plans.warehouse import SOURCES, Warehouse
from avisflow.session import built_once, input_state, materialized_table, scratch_path
from avisflow.sources.tables import table_path
from avisflow.sources.versions import read_current, replace_version

Query = Callable[[SparkSession, str], DataFrame]
STG_COLUMNS = ["review_id", "doc_id", "bank", "agency", "url", "location", "author", "rating", "review_date",
               "review_text", "clean_text", "detected_language", "text_length", "text_quality"]


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Plans that read the staged reviews once: nothing to share, nothing materialised."""
    return Warehouse(spark, sf_dir)


def _whm(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Plans that read the staged reviews through several branches (annotations, fact and
    dimensions): they read tables that are built once per application and input state."""
    return Warehouse(spark, sf_dir, materialize=True)


def _wht(spark: SparkSession, sf_dir: str) -> Warehouse:
    """As ``_whm`` for outputs that carry the texts: the staged table is written with them."""
    return Warehouse(spark, sf_dir, materialize="text")


QUERIES: dict[str, Query] = {
    "fixture_staging_reviews": lambda s, d: _wh(s, d).staging_reviews,
    "stg_reviews": lambda s, d: _wh(s, d).stg_reviews.select(*STG_COLUMNS),
    "dedup_latest": lambda s, d: _wh(s, d).stg_reviews.select(
        "bank", "agency", "author", "clean_text", "review_date", "rating", "review_id"),
    "reviews_enriched": lambda s, d: _wht(s, d).reviews_enriched,
    "fact_reviews": lambda s, d: _whm(s, d).fact_reviews,
    "reviews_enriched_scored": lambda s, d: _wht(s, d).reviews_enriched,
    "dim_bank": lambda s, d: _whm(s, d).dim_bank,
    "dim_bank_window_form": lambda s, d: star.dim_bank_window_form(_whm(s, d).enriched_core),
    "dim_branch": lambda s, d: _whm(s, d).dim_branch,
    "dim_location": lambda s, d: _whm(s, d).dim_location,
    "dim_sentiment": lambda s, d: _whm(s, d).dim_sentiment,
    "branch_performance": lambda s, d: _whm(s, d).branch_performance(),
    "customer_insights": lambda s, d: _whm(s, d).customer_insights(),
    "sentiment_trends": lambda s, d: _whm(s, d).sentiment_trends(),
    "topic_analysis": lambda s, d: _whm(s, d).topic_analysis(),
    "distinct_sketches": lambda s, d: _distinct_sketches(s, d),
    "stg_reviews_row_id": lambda s, d: _row_ids(s, d),
    # step-level views of the same models
    "detected_language": lambda s, d: _wh(s, d).stg_reviews.select(
        "review_id", "detected_language", "text_quality", "text_length"),
    "surrogate_keys": lambda s, d: _surrogate_keys(s, d),
    "iso_date_filter": lambda s, d: _iso_dates(s, d),
    "date_buckets": lambda s, d: _date_buckets(s, d),
    "case_classifiers": lambda s, d: _whm(s, d).enriched_core.select(
        "review_id", "rating_sentiment", "sentiment_rating_consistency", "agency_type"),
    # data quality
    "dq_unique": lambda s, d: _dims(quality.dq_unique, s, d),
    "dq_not_null": lambda s, d: _dims(quality.dq_not_null, s, d),
    "dq_relationships": lambda s, d: _dims(quality.dq_relationships, s, d),
    "dedup_rate": lambda s, d: quality.dedup_rate(_wh(s, d).staging_reviews),
    "text_quality_stats": lambda s, d: quality.text_quality_stats(_wh(s, d).stg_reviews),
    "sentiment_stats": lambda s, d: quality.sentiment_stats(_whm(s, d).enriched_core),
    "consistency_share": lambda s, d: quality.consistency_share(_whm(s, d).enriched_core),
    "language_share": lambda s, d: quality.language_share(_wh(s, d).stg_reviews),
    "topic_stats": lambda s, d: quality.topic_stats(_whm(s, d).enriched_core),
    "topic_by_sentiment": lambda s, d: quality.topic_by_sentiment(_whm(s, d).enriched_core),
    "bank_stats": lambda s, d: quality.bank_stats(_whm(s, d).enriched_core),
    "quality_metrics": lambda s, d: quality.quality_metrics(_whm(s, d).enriched_core),
    "quality_alerts": lambda s, d: quality.quality_alerts(_whm(s, d).enriched_core),
    # collection shaping over fetched pages / texts
    "bank_from_query": lambda s, d: collect.bank_from_query(_src(s, d).pages),
    "agency_urls": lambda s, d: collect.agency_urls(_src(s, d).pages),
    "page_field_extract": lambda s, d: collect.page_field_extract(collect.with_review_pages(_src(s, d).pages)),
    "review_keep": lambda s, d: collect.review_keep(collect.with_review_pages(_src(s, d).pages)),
    "page_reviews": lambda s, d: collect.page_reviews(collect.with_review_lists(_src(s, d).pages)),
    "page_review_counts": lambda s, d: collect.page_review_counts(collect.with_review_lists(_src(s, d).pages)),
    "address_guess": lambda s, d: collect.address_guess(_src(s, d).documents),
    "address_clean": lambda s, d: collect.address_clean(_src(s, d).documents),
    "rating_parse": lambda s, d: collect.rating_parse(_src(s, d).documents),
    "reviews_per_agency": lambda s, d: collect.reviews_per_agency(_wh(s, d).staging_reviews),
    "agency_details": lambda s, d: collect.agency_details(collect.with_review_pages(_src(s, d).pages)),
    # sentiment and language
    "sentiment_lexicon_score": lambda s, d: sentiment.sentiment_analysis(_wh(s, d).stg_reviews),
    "polarity_score": lambda s, d: sentiment.sentiment_analysis(_wh(s, d).stg_reviews).select(
        "review_id", "textblob_polarity"),
    "sentiment_label": lambda s, d: sentiment.sentiment_analysis(_wh(s, d).stg_reviews).select(
        "review_id", "sentiment", "confidence"),
    "rule_sentiment": lambda s, d: _rules(s, d, "rule_scores"),
    "phrase_polarity": lambda s, d: _rules(s, d, "phrase_scores"),
    "language_keyword_fallback": lambda s, d: sentiment.language_keyword_fallback(_src(s, d).documents),
    "language_ngram": lambda s, d: sentiment.language_ngram(_src(s, d).documents),
    # topics
    "topic_preprocess": lambda s, d: topics.topic_documents(_wh(s, d).stg_reviews).select(
        "review_id", "language", "lda_text"),
    "language_gate": lambda s, d: topics.language_gate(_wh(s, d).stg_reviews),
    "tfidf_terms": lambda s, d: topics.tfidf_terms(_wh(s, d).stg_reviews),
    "topic_keyword_assignment": lambda s, d: topics.keyword_topics(_wh(s, d).stg_reviews),
    "topic_top_keywords": lambda s, d: topics.top_keywords(topics.tfidf_terms(_wh(s, d).stg_reviews)),
    "topic_category_match": lambda s, d: topics.topic_category_match(topics.tfidf_terms(_wh(s, d).stg_reviews)),
    "lda_topics": lambda s, d: _lda(s, d)[0],
    "topic_assignment": lambda s, d: topics.topic_assignment(*_lda(s, d)),
    "tfidf_weights": lambda s, d: _weights(s, d),
    "em_topics": lambda s, d: topic_model.topic_words(_em(s, d)[0]),
    "em_topic_assignment": lambda s, d: topics.topic_assignment(topics.category_scores(_em(s, d)[0]), _em(s, d)[1]),
    # sources and sinks
    "csv_roundtrip": lambda s, d: _csv_roundtrip(s, d),
    "csv_kept": lambda s, d: _csv_checked(s, d)[0],
    "csv_quarantine": lambda s, d: _csv_checked(s, d)[1],
    "stream_ingest": lambda s, d: _stream_ingest(s, d),
    "append_sink": lambda s, d: _append_sink(s, d),
    "replace_sink": lambda s, d: _replace_sink(s, d),
    "append_sink_retried": lambda s, d: _append_retried(s, d),
    "stream_ingest_retried": lambda s, d: _stream_retried(s, d),
    "dim_bank_merged": lambda s, d: _dim_bank_merged(s, d),
    "topic_category_distribution": lambda s, d: quality.topic_category_distribution(_whm(s, d).topic_assignments),
}


def _surrogate_keys(spark, sf_dir):
    from avisflow.functions.keys import surrogate_key
    return _wh(spark, sf_dir).stg_core.select(
        "review_id", surrogate_key("bank").alias("bank_key"),
        surrogate_key("agency", "bank", "location").alias("branch_key"),
        surrogate_key("location").alias("location_key"))


def _iso_dates(spark, sf_dir):
    """FLT-3 + DAT-1 over every staged row (null, relative and impossible dates included)."""
    from avisflow.functions.dates import iso_date_or_null
    st = _wh(spark, sf_dir).staging_reviews
    return st.select("doc_id", "review_date", is_iso_date("review_date").alias("is_iso"),
                     iso_date_or_null("review_date").alias("review_day"))


def _date_buckets(spark, sf_dir):
    """DAT-2/DAT-3/FLT-4: month and quarter buckets and the two rolling windows of the views."""
    from avisflow.functions.dates import iso_to_date, month_bucket, months_back, quarter_bucket
    w = _wh(spark, sf_dir)
    d = iso_to_date("review_date")
    return (w.stg_core.where(is_iso_date("review_date"))
            .select("review_id", d.alias("review_day"))
            .select("review_id", "review_day", month_bucket(F.col("review_day")).alias("review_month"),
                    quarter_bucket(F.col("review_day")).alias("review_quarter"),
                    (F.col("review_day") >= months_back(w.as_of, 12)).alias("in_last_12_months"),
                    (F.col("review_day") >= months_back(w.as_of, 24)).alias("in_last_24_months")))


def _distinct_sketches(spark, sf_dir):
    """AGG-2 by sketches: the monthly table is written, every coarser count comes from it."""
    enriched = _whm(spark, sf_dir).enriched_core
    return distinct.checked(materialized_table(distinct.monthly_sketches(enriched), "monthly_sketches"), enriched)


def _row_ids(spark, sf_dir):
    """WIN-1: the staging model's global ROW_NUMBER (bank, agency, author, review_date), made a
    total order by the content-hash id, as a dense id next to the hash id."""
    from avisflow.operators.rownum import dense_row_number
    stg = _wh(spark, sf_dir).stg_core.select("review_id", "bank", "agency", "author", "review_date")
    order = [F.col(c).asc_nulls_last() for c in ("bank", "agency", "author", "review_date", "review_id")]
    return dense_row_number(stg, order, "row_id")


def _csv_roundtrip(spark, sf_dir):
    """SNK-3 then SRC-1: the staged fixture written as raw CSV and read back."""
    from avisflow.sources.reviews_csv import read_reviews_csv
    from avisflow.sources.sinks import write_reviews_csv
    path = scratch_path(spark, "sinks", "csv")
    write_reviews_csv(_wh(spark, sf_dir).staging_reviews, path)
    return read_reviews_csv(spark, path)


def _csv_checked(spark, sf_dir):
    """SRC-1 over bad input: the staged fixture as raw CSV, with files of too few and too many
    fields, repeated headers and ratings that are no numbers beside it."""
    from avisflow.sources.reviews_csv import RAW_COLUMNS, read_checked
    from avisflow.sources.sinks import CSV_WRITE_OPTIONS, to_raw, write_reviews_csv
    path = scratch_path(spark, "sinks", "csv-bad")
    staging = _wh(spark, sf_dir).staging_reviews
    write_reviews_csv(staging, path)
    d = F.col("doc_id")
    some = [staging.where(d % 11 == 3).select("bank", "agency", "url"),
            to_raw(staging.where(d % 13 == 4)).select(*RAW_COLUMNS, F.lit("x").alias("more")),
            to_raw(staging.where(d % 17 == 5)).select(*[F.lit(c).alias(c) for c in RAW_COLUMNS]),
            to_raw(staging.where(d % 19 == 6)).withColumns({"rating": F.lit("five"), "text": F.lit("text")})]
    for part in some:
        part.write.mode("append").options(**CSV_WRITE_OPTIONS).csv(path)
    return read_checked(spark, path)


def _append_sink(spark, sf_dir):
    """SNK-1: two daily batches appended to the raw table and read back with their ingest dates."""
    import datetime as dt

    from avisflow.sources.sinks import append_staging
    path = scratch_path(spark, "sinks", "append")
    raw = _wh(spark, sf_dir).staging_reviews
    dated = F.coalesce(is_iso_date("review_date"), F.lit(False))
    append_staging(raw.where(dated), path, dt.date(2024, 1, 1))
    append_staging(raw.where(~dated), path, dt.date(2024, 1, 2))
    return spark.read.parquet(path)


def _replace_sink(spark, sf_dir):
    """SNK-2: the sentiment table replaces what an earlier run left under its name."""
    from avisflow.sources.sinks import replace_table
    path = scratch_path(spark, "sinks", "replace")
    w = _whm(spark, sf_dir)
    replace_table(w.sentiment_analysis.limit(0), path)
    replace_table(w.sentiment_analysis, path)
    return read_current(spark, path)


def _append_retried(spark, sf_dir):
    """SNK-1 with retries: two daily batches, each sent twice, stored once."""
    import datetime as dt

    from avisflow.sources.sinks import append_batch
    path = scratch_path(spark, "sinks", "retried")
    raw = _wh(spark, sf_dir).staging_reviews
    dated = F.coalesce(is_iso_date("review_date"), F.lit(False))
    for _ in range(2):
        append_batch(raw.where(dated), path, dt.date(2024, 1, 1), "daily")
        append_batch(raw.where(~dated), path, dt.date(2024, 1, 2), "daily")
    return spark.read.parquet(path).drop("batch_id")


def _stream_retried(spark, sf_dir):
    """SNK-1 as a stream that starts again without its checkpoint: the same rows, once."""
    import datetime as dt

    from avisflow.sources.sinks import write_reviews_csv
    from avisflow.streaming.ingest import ingest_batches
    root = scratch_path(spark, "sinks", "stream-retried")
    write_reviews_csv(_wh(spark, sf_dir).staging_reviews, f"{root}/incoming")
    for attempt in range(2):
        ingest_batches(spark, f"{root}/incoming", f"{root}/staging_reviews", f"{root}/_checkpoint-{attempt}", dt.date(2024, 1, 1))
    return spark.read.parquet(f"{root}/staging_reviews").drop("ingest_date", "batch_id")


def _dim_bank_merged(spark, sf_dir):
    """DAT-4: the bank dimension of the dated reviews, then of all reviews, merged under fixed clocks
    through a versioned table."""
    import datetime as dt

    from avisflow.operators.merge import merge_dimension
    path = scratch_path(spark, "sinks", "dim_bank")
    enriched = _whm(spark, sf_dir).enriched_core
    dated = F.coalesce(is_iso_date("review_date"), F.lit(False))
    replace_version(merge_dimension(star.dim_bank(enriched.where(dated)), None, "bank_key", dt.datetime(2024, 1, 1)), path)
    replace_version(merge_dimension(star.dim_bank(enriched), read_current(spark, path), "bank_key", dt.datetime(2024, 2, 1)), path)
    return read_current(spark, path)


def _stream_ingest(spark, sf_dir):
    """SNK-1 as a stream: CSV drops -> AvailableNow file-source stream -> partitioned raw table."""
    from avisflow.sources.sinks import write_reviews_csv
    from avisflow.streaming.ingest import ingest_available
    root = scratch_path(spark, "sinks", "stream")
    write_reviews_csv(_wh(spark, sf_dir).staging_reviews, f"{root}/incoming")
    ingest_available(spark, f"{root}/incoming", f"{root}/staging_reviews", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/staging_reviews").drop("ingest_date")


def _lda(spark, sf_dir):
    """Topics and assignments of one fit per language, written once per application and input state."""
    w, fitted = _wh(spark, sf_dir), []

    def part(i):
        if not fitted:
            docs = topics.topic_documents(w.stg_reviews)
            fitted.extend(topics.lda_fit(docs, topics.vocabulary_of(docs)))
        return fitted[i]

    state = input_state(spark, [table_path(sf_dir, t) for t in SOURCES])
    return [built_once(spark, name, state, lambda i=i: part(i)) for i, name in enumerate(("lda_topics", "lda_assigned"))]


def _rules(spark, sf_dir, which):
    weights, modifiers, phrases = sentiment_rules.default_tables(spark)
    stg = _wh(spark, sf_dir).stg_reviews
    if which == "rule_scores":
        return sentiment_rules.rule_scores(stg, weights, modifiers)
    return sentiment_rules.phrase_scores(stg, phrases, modifiers)


def _topic_input(spark, sf_dir):
    docs = topics.topic_documents(_wh(spark, sf_dir).stg_reviews)
    return docs, materialized_table(topics.vocabulary_of(docs), "topic_vocabulary")


def _weights(spark, sf_dir):
    return topic_model.document_weights(*_topic_input(spark, sf_dir))


def _em(spark, sf_dir):
    """Topics and assignments of the checked model, written once per application and input state."""
    fitted = []

    def part(i):
        if not fitted:
            fitted.extend(topic_model.fit(*_topic_input(spark, sf_dir)))
        return fitted[i]

    state = input_state(spark, [table_path(sf_dir, t) for t in SOURCES])
    return [built_once(spark, name, state, lambda i=i: part(i)) for i, name in enumerate(("em_topics", "em_assigned"))]


def _src(spark, sf_dir):
    return _wh(spark, sf_dir).src


def _dims(fn, spark, sf_dir):
    w = _whm(spark, sf_dir)
    return fn(w.dim_bank, w.dim_branch, w.dim_sentiment)
