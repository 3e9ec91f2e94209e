import datetime as dt

from pyspark.sql import functions as F

from avisflow.plans import build
from support import SF_SMALL


def test_full_build_writes_every_table(spark, tmp_path):
    out = str(tmp_path / "warehouse")
    paths = build.run(spark, SF_SMALL, out_dir=out, ingest_date=dt.date(2024, 12, 31))
    for name in ["stg_reviews", "sentiment_analysis", "topics", "topic_analysis", "reviews_enriched", "fact_reviews",
                 "dim_bank", "dim_branch", "dim_location", "dim_sentiment", "branch_performance",
                 "customer_insights", "sentiment_trends", "topic_analysis_view", "dq_tests", "quality_alerts"]:
        assert name in paths
    read = lambda n: spark.read.parquet(paths[n])
    assert read("stg_reviews").count() == read("fact_reviews").count() == read("reviews_enriched").count() == 208
    assert read("sentiment_analysis").count() == 208
    assert read("dq_tests").where(F.col("failures") > 0).count() == 0
    assigned = read("topic_analysis")
    assert assigned.count() > 0
    assert assigned.where((F.col("topic_confidence") < 0) | (F.col("topic_confidence") > 1)).count() == 0
    assert read("branch_performance").count() > 0
