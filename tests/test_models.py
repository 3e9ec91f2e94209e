import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as E
from avisflow.plans import enrich, quality, staging, star, views
from avisflow.plans.warehouse import Warehouse
from support import SF_SMALL, rows

STAGING = "doc_id long, bank string, agency string, url string, location string, author string, rating double, " \
          "review_date string, review_text string"


def _staging(spark, data):
    return spark.createDataFrame(data, STAGING)


def test_stg_filters_boundaries_and_dedups(spark):
    data = [
        (1, "B", "A", "u", "L", "au", 0.0, "2024-01-01", "zero rating is dropped"),
        (2, "B", "A", "u", "L", "au", 5.1, "2024-01-01", "above five is dropped"),
        (3, "B", "A", "u", "L", "au", None, "2024-01-01", "null rating is dropped"),
        (4, "B", "A", "u", "L", "au", 1.0, "2024-01-01", "   "),
        (5, "B", "A", "u", "L", "au", 3.5, "2024-01-02", "Same Text"),
        (6, "B", "A", "u", "L", "au", 4.0, None, "  same text "),
        (7, "B", "A", "u", "L", "au", 5.0, "2024-01-01", "kept, five"),
        (8, "B", "A", "u", "L", "au", 1.0, "2024-01-01", "kept, one"),
    ]
    stg = staging.stg_reviews(_staging(spark, data))
    assert rows(stg, "doc_id") == [(6,), (7,), (8,)]
    r = {x.doc_id: x for x in stg.collect()}
    assert r[6].clean_text == "same text" and r[6].text_length == 12


def test_dim_bank_group_form_equals_window_form(spark):
    w = Warehouse(spark, SF_SMALL)
    assert rows(w.dim_bank) == rows(star.dim_bank_window_form(w.reviews_enriched))


def test_fact_keeps_every_review_and_dimensions_have_no_orphans(spark):
    w = Warehouse(spark, SF_SMALL)
    assert w.fact_reviews.count() == w.reviews_enriched.count() == 208
    rel = quality.dq_relationships(w.dim_bank, w.dim_branch, w.dim_sentiment)
    assert all(r.failures == 0 for r in rel.collect())
    uniq = quality.dq_unique(w.dim_bank, w.dim_branch, w.dim_sentiment)
    assert all(r.failures == 0 for r in uniq.collect())
    # every fact key finds its dimension row
    f = w.fact_reviews
    assert f.join(w.dim_branch, "branch_key", "left_anti").where(F.col("branch_key").isNotNull()).count() == 0


def test_customer_insights_lag_skips_missing_quarter(spark):
    data = [(i, "B", "A", "u", "L", f"a{i}", float(r), d, f"text {i}")
            for i, (r, d) in enumerate([(5, "2024-01-10"), (3, "2024-02-10"), (1, "2024-07-01"), (2, "2024-07-02")])]
    stg = staging.stg_reviews(_staging(spark, data))
    sent = stg.select("review_id", F.lit("positive").alias("sentiment"), F.lit(0.5).alias("vader_compound"),
                      F.lit(0.1).alias("textblob_polarity"), F.lit(0.5).alias("confidence"))
    enr = enrich.reviews_enriched(stg, sent)
    fact = star.fact_reviews(enr)
    ci = views.customer_insights(fact, star.dim_bank(enr), star.dim_branch(stg), star.dim_location(stg),
                                 dt.date(2024, 12, 31))
    got = rows(ci, "review_quarter", "total_reviews", "avg_rating", "prev_quarter_rating", "prev_quarter_volume")
    assert got == [(dt.date(2024, 1, 1), 2, 4.0, None, None), (dt.date(2024, 7, 1), 2, 1.5, 4.0, 2)]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 19
    assert "rating_rank" in df.columns


def test_inner_star_join_loses_only_rows_without_dimension(spark):
    w = Warehouse(spark, SF_SMALL, materialize=True)
    enr = w.enriched_core
    fact = w.fact_reviews
    joined = (fact.join(w.dim_bank.select("bank_key"), "bank_key")
                  .join(w.dim_branch.select("branch_key"), "branch_key")
                  .join(w.dim_location.select("location_key"), "location_key"))
    keepable = enr.where(F.col("bank").isNotNull() & F.col("agency").isNotNull() & F.col("location").isNotNull())
    assert joined.count() == keepable.count()
    # and the sentiment dimension keeps exactly the scored reviews
    with_sent = fact.join(w.dim_sentiment.select("sentiment_key"), "sentiment_key")
    assert with_sent.count() == enr.where(F.col("sentiment").isNotNull() & F.col("bank").isNotNull()).count()


def test_review_ids_are_injective_in_the_fields(spark):
    data = [(1, "B", "X-Y", "u", "L", "Z", 4.0, "2024-01-01", "same words"), (2, "B", "X", "u", "L", "Y-Z", 4.0, "2024-01-01", "same words"),
            (3, "B", "X", "u", "L", None, 4.0, "2024-01-01", "same words"), (4, "B", "X", "u", "L", "~", 4.0, "2024-01-01", "same words")]
    ids = [r.review_id for r in staging.stg_reviews(_staging(spark, data)).collect()]
    assert len(ids) == len(set(ids)) == 4


def test_survivor_does_not_depend_on_row_order(spark):
    data = [(1, "B", "A", "u", "L", "au", 4.0, "2024-01-01", "same"), (1, "B", "A", "u", "L", "au", 1.0, "2024-01-01", "same"),
            (1, "B", "A", "v", "K", "au", 1.0, "2024-01-01", "same")]
    kept = {tuple(staging.stg_reviews(_staging(spark, rows_)).collect()) for rows_ in (data, data[::-1], data[1:] + data[:1])}
    assert len(kept) == 1 and [r.rating for r in kept.pop()] == [1.0]


def test_not_null_checks_find_literal_rows(spark):
    bank = spark.createDataFrame([(None, "B"), ("k", None), ("k", "B")], "bank_key string, bank_name string")
    branch = spark.createDataFrame([(None, "B"), ("k", None)], "branch_key string, bank string")
    sent = spark.createDataFrame([(None, None)], "sentiment_key string, bank string")
    assert [r.failures for r in quality.dq_not_null(bank, branch, sent).collect()] == [1, 1, 1, 1, 1, 1]
    assert [r.failures for r in quality.dq_unique(bank, branch, sent).collect()] == [1, 0, 0]


def test_unscored_reviews_stay_and_count_as_incoherent(spark):
    data = [(i, "B", "A", "u", "L", f"a{i}", 4.0, "2024-01-01", f"text {i}") for i in range(3)]
    stg = staging.stg_reviews(_staging(spark, data))
    sent = stg.where("doc_id = 0").select("review_id", F.lit("positive").alias("sentiment"), F.lit(0.5).alias("vader_compound"),
                                          F.lit(0.1).alias("textblob_polarity"), F.lit(0.5).alias("confidence"))
    enr = enrich.reviews_enriched(stg, sent)
    assert sorted((r.sentiment or "", r.sentiment_rating_consistency) for r in enr.collect()) == \
        [("", "incoherent"), ("", "incoherent"), ("positive", "coherent")]
    assert star.fact_reviews(enr).agg(F.sum("is_positive")).first()[0] == 1
    assert star.dim_sentiment(enr).count() == 1
    alerts = {r.check_name: r for r in quality.quality_alerts(enr.withColumn("confidence", F.lit(0.0))).collect()}
    assert alerts["sentiment_coverage"].triggered and not alerts["avg_confidence"].triggered


def test_dedup_rate_counts_in_one_pass(spark):
    w = Warehouse(spark, SF_SMALL)
    r = quality.dedup_rate(w.staging_reviews).first()
    assert (r.original_count, r.cleaned_count) == (w.staging_reviews.count(), w.stg_reviews.count())


def test_tables_are_built_once_and_again_for_other_inputs(spark, tmp_path):
    import shutil
    a, b = Warehouse(spark, SF_SMALL, materialize=True), Warehouse(spark, SF_SMALL, materialize=True)
    assert a.fact_reviews.inputFiles() == b.fact_reviews.inputFiles()
    shutil.copytree(SF_SMALL, tmp_path / "sf")
    c = Warehouse(spark, str(tmp_path / "sf"), materialize=True)
    assert c.fact_reviews.inputFiles() != a.fact_reviews.inputFiles() and c.fact_reviews.count() == a.fact_reviews.count()


def test_star_joins_do_not_shuffle_the_fact(spark):
    w = Warehouse(spark, SF_SMALL, materialize=True)
    plan = views._star(w.fact_reviews, w.dim_bank, w.dim_branch, w.dim_location)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
