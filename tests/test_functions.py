import datetime as dt
import hashlib

from pyspark.sql import functions as F

from avisflow.functions import classify, dates, keys, text
from avisflow.functions.numeric import percent, pg_round


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def test_surrogate_key_matches_convention(spark):
    df = spark.createDataFrame([("a", None), ("a-b", "c")], "x string, y string")
    got = [r[0] for r in df.select(keys.surrogate_key("x", "y")).collect()]
    assert got == [md5("a-_dbt_utils_surrogate_key_null_"), md5("a-b-c")]


def test_round_half_away_from_zero_and_percent(spark):
    df = spark.createDataFrame([(1.005, 1, 3), (2.5, 2, 3), (-0.0445, 0, 0)], "x double, a int, b int")
    out = df.select(pg_round("x", 2).alias("r2"), pg_round("x", 0).alias("r0"),
                    percent(F.col("a"), F.col("b"), 2).alias("p")).collect()
    assert [(r.r2, r.r0, r.p) for r in out] == [(1.01, 1.0, 33.33), (2.5, 3.0, 66.67), (-0.04, -0.0, None)]


def test_language_rule_order_and_boundaries(spark):
    cases = [("TRÈS bien", "fr"), ("ça va", "fr"), ("the agency", "en"), ("theory", "unknown"),
             ("in", "en"), ("خدمة جيدة في الوكالة", "ar"), ("The café is ok", "fr"), ("xyz 123", "unknown"),
             ("Rock and roll", "en"), ("handover", "unknown")]
    df = spark.createDataFrame(cases, "t string, want string")
    got = df.select("want", text.detected_language("t").alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_text_quality_boundaries_on_trimmed_length(spark):
    vals = [" " + "a" * 9 + " ", "a" * 10, "a" * 500, "a" * 501]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    assert [r[0] for r in df.select(text.text_quality("t")).collect()] == ["short", "normal", "normal", "long"]


def test_rating_classes_and_consistency(spark):
    ratings = [1.0, 2.0, 3.0, 3.5, 4.0, 5.0]
    df = spark.createDataFrame([(r, s) for r in ratings for s in ("positive", "negative", "neutral", None)],
                               "rating double, sentiment string")
    out = df.select("rating", "sentiment", classify.rating_sentiment().alias("rs"),
                    classify.sentiment_rating_consistency().alias("c")).collect()
    for r in out:
        assert r.rs == ("positive" if r.rating >= 4 else "negative" if r.rating <= 2 else "neutral")
        coherent = ((r.sentiment == "positive" and r.rating >= 4) or (r.sentiment == "negative" and r.rating <= 2)
                    or (r.sentiment == "neutral" and r.rating == 3))
        assert r.c == ("coherent" if coherent else "incoherent")


def test_sentiment_label_thresholds(spark):
    df = spark.createDataFrame([(0.05,), (0.0499,), (-0.05,), (-0.0499,), (None,)], "c double")
    assert [r[0] for r in df.select(classify.sentiment_label("c")).collect()] == \
        ["positive", "neutral", "negative", "neutral", "neutral"]


def test_data_quality_score_tiers(spark):
    rows = [(0.61, 0.31, 51), (0.6, 0.31, 51), (0.41, 0.21, 31), (0.31, 0.0, 21), (0.21, None, 11), (0.2, 1.0, 99),
            (None, 1.0, 99)]
    df = spark.createDataFrame(rows, "c double, t double, n int")
    got = [r[0] for r in df.select(classify.data_quality_score("c", "t", "n")).collect()]
    assert got == [5, 4, 4, 3, 2, 1, 1]


def test_bank_categories(spark):
    df = spark.createDataFrame([(4.0, 100), (3.99, 99), (3.5, 50), (3.0, 49), (2.99, 0)], "a double, n long")
    out = df.select(classify.performance_category("a"), classify.size_category("n")).collect()
    assert [tuple(r) for r in out] == [("Excellent", "Grande banque"), ("Bon", "Banque moyenne"),
                                       ("Bon", "Banque moyenne"), ("Moyen", "Petite banque"),
                                       ("Faible", "Petite banque")]


def test_agency_type_keeps_unreachable_branch(spark):
    df = spark.createDataFrame([("X Centre Commercial",), ("Y Mall",), ("centre ville",), ("Z",)], "a string")
    assert [r[0] for r in df.select(classify.agency_type("a")).collect()] == \
        ["centre-ville", "centre-commercial", "centre-ville", "standard"]


def test_iso_dates(spark):
    df = spark.createDataFrame([("2024-02-29",), ("2024-13-45",), ("il y a 2 mois",), (None,), ("2024-1-05",)],
                               "d string")
    out = df.select(dates.is_iso_date("d").alias("ok"), dates.iso_to_date("d").alias("day")).collect()
    assert [(r.ok, r.day) for r in out] == [(True, dt.date(2024, 2, 29)), (True, None), (False, None),
                                            (None, None), (False, None)]


def test_months_back_clamps(spark):
    out = spark.range(1).select(dates.months_back(dt.date(2024, 3, 31), 1).alias("d")).collect()
    assert out[0].d == dt.date(2024, 2, 29)
