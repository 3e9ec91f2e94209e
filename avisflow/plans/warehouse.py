"""Build order (§3.4) as lazily-built DataFrames over one data directory.

``Warehouse(spark, sf_dir)`` wires the models together; attributes are plans, not data, and
nothing runs until an action, unless ``materialize`` asks for tables. The same models feed the
driver queries and the daily build (``plans/build.py``).
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from avisflow.functions.dates import DEFAULT_AS_OF
from avisflow.plans import enrich, fixtures, sentiment, staging, star, topics, views
from avisflow.session import built_once, input_state
from avisflow.sources.tables import Catalog, table_path

TEXT_COLUMNS = ("review_text", "clean_text")
#: What the sentiment and topic jobs add to a staged review.
JOB_COLUMNS = ("vader_compound", "textblob_polarity", "lexicon_hits", "dominant_topic", "topic_category",
               "topic_keywords", "topic_confidence")
SOURCES = ("documents", "supplier", "nation", "customer", "labels")


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of: dt.date = DEFAULT_AS_OF,
                 tables: dict[str, DataFrame] | None = None, materialize: bool | str = False):
        """``materialize``: for plans that read the staged reviews through several branches (every
        view joins the fact with dimensions that all derive from them). The text-free staged core,
        with the columns of the sentiment and topic jobs computed in the same pass over the texts,
        the enriched core, the fact and the dimensions are then written to the shared folder once
        per application and input state, as the daily build would, and every later query reads the
        columns it needs from them. ``materialize="text"`` does so for the staged table with texts
        (outputs that carry them)."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        self.materialize = materialize
        self.src = Catalog(spark, sf_dir)
        self._override = dict(tables or {})

    def _get(self, name: str, build):
        if name in self._override:
            return self._override[name]
        return build()

    def _table(self, name: str, build):
        """An override, a table built once per application, or just its plan."""
        if name in self._override or not self.materialize:
            return self._get(name, build)
        state = None if self._override else self._state
        return built_once(self.spark, name, state, build)

    @cached_property
    def _state(self):
        return input_state(self.spark, [table_path(self.sf_dir, t) for t in SOURCES])

    # -- inputs -------------------------------------------------------------
    @cached_property
    def staging_reviews(self) -> DataFrame:
        s = self.src
        return self._get("staging_reviews",
                         lambda: fixtures.staging_reviews(s.documents, s.supplier, s.nation, s.customer))

    @cached_property
    def stg_reviews(self) -> DataFrame:
        return self._get("stg_reviews", lambda: staging.stg_reviews(self.staging_reviews))

    @cached_property
    def _jobs(self) -> DataFrame:
        """Staged reviews with the sentiment and topic jobs' columns, computed where the texts are
        read: without texts in the result, none is shuffled for the de-duplication."""
        def scored(df):
            return topics.with_keyword_topic(sentiment.with_scores(df, "clean_text"))

        drop = () if self.materialize == "text" else TEXT_COLUMNS
        if "stg_reviews" in self._override:
            build = lambda: scored(self.stg_reviews).drop(*drop)
        else:
            build = lambda: staging.stg_reviews(self.staging_reviews, scored, drop)
        return self._table("stg_scored_text" if self.materialize == "text" else "stg_scored", build)

    @cached_property
    def stg_text(self) -> DataFrame:
        """Staged reviews with texts."""
        return self._jobs.drop(*JOB_COLUMNS) if self.materialize == "text" else self.stg_reviews

    @cached_property
    def stg_core(self) -> DataFrame:
        """Staged reviews without the text columns."""
        if not self.materialize:
            return self.stg_reviews.drop(*TEXT_COLUMNS)
        return self._jobs.drop(*JOB_COLUMNS, *TEXT_COLUMNS)

    @cached_property
    def sentiment_analysis(self) -> DataFrame:
        return self._get("sentiment_analysis", lambda: sentiment.sentiment_table(self._jobs).drop("lexicon_hits"))

    @cached_property
    def topic_assignments(self) -> DataFrame:
        return self._get("topic_analysis", lambda: topics.topic_table(self._jobs.where(
            (F.col("text_length") > topics.MIN_TEXT_LENGTH) & (F.col("detected_language") != "unknown"))))

    @cached_property
    def annotations(self) -> DataFrame:
        return self._get("annotations", lambda: fixtures.annotations_fixture(self.stg_core, self.src.labels))

    # -- marts --------------------------------------------------------------
    @cached_property
    def reviews_enriched(self) -> DataFrame:
        """Full enriched rows (with texts), as the model's table."""
        return self._get("reviews_enriched", lambda: enrich.reviews_enriched(
            self.stg_text, self.sentiment_analysis, self.topic_assignments, self.annotations))

    @cached_property
    def enriched_core(self) -> DataFrame:
        """Enriched rows without texts: the input of the fact and the dimensions."""
        if "reviews_enriched" in self._override:
            return self._override["reviews_enriched"].drop(*TEXT_COLUMNS)
        return self._table("enriched_core", lambda: enrich.reviews_enriched(
            self.stg_core, self.sentiment_analysis, self.topic_assignments, self.annotations))

    @cached_property
    def fact_reviews(self) -> DataFrame:
        return self._table("fact_reviews", lambda: star.fact_reviews(self.enriched_core))

    @cached_property
    def dim_bank(self) -> DataFrame:
        return self._table("dim_bank", lambda: star.dim_bank(self.enriched_core))

    @cached_property
    def dim_branch(self) -> DataFrame:
        return self._table("dim_branch", lambda: star.dim_branch(self.stg_core))

    @cached_property
    def dim_location(self) -> DataFrame:
        return self._table("dim_location", lambda: star.dim_location(self.stg_core))

    @cached_property
    def dim_sentiment(self) -> DataFrame:
        return self._table("dim_sentiment", lambda: star.dim_sentiment(self.enriched_core))

    # -- views --------------------------------------------------------------
    def branch_performance(self) -> DataFrame:
        return views.branch_performance(self.fact_reviews, self.dim_bank, self.dim_branch, self.dim_location)

    def customer_insights(self) -> DataFrame:
        return views.customer_insights(self.fact_reviews, self.dim_bank, self.dim_branch, self.dim_location,
                                       self.as_of)

    def sentiment_trends(self) -> DataFrame:
        return views.sentiment_trends(self.fact_reviews, self.dim_bank, self.dim_branch, self.dim_location,
                                      self.dim_sentiment, self.as_of)

    def topic_analysis(self) -> DataFrame:
        return views.topic_analysis(self.fact_reviews, self.dim_bank, self.dim_branch, self.dim_location)
