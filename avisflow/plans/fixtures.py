"""Step 0: test inputs derived from the driver tables.

``staging_reviews`` maps ``documents`` (joined to supplier, nation, customer) onto the raw
review schema: every document once with its whole text, plus further rows of some documents
(re-dated and re-spaced copies, blank and Arabic texts, missing and zero ratings) so that
filters, de-duplication, null dates and trim/lower have work to do. Sentiment and topics come
from the jobs themselves; the business annotations from ``labels``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from avisflow.operators.joins import broadcast_if_small, one_row

# ---------------------------------------------------------------------------
# Rules of the fixture (FIXTURES.md §3).
AGENCY_SUFFIX = {0: " Centre", 1: " Mall"}           # by s_suppkey % 4
URL_PREFIX = "https://example.com/a/"
RELATIVE_DATE = "il y a 2 mois"
FIRST_DAY = "2023-01-01"
DAY_SPAN = 730
ARABIC_REVIEW = "خدمة جيدة في الوكالة "
# ---------------------------------------------------------------------------


def staging_reviews(documents: DataFrame, supplier: DataFrame, nation: DataFrame,
                    customer: DataFrame) -> DataFrame:
    d = F.col("doc_id")
    counts = one_row(
        supplier.agg(F.count(F.lit(1)).alias("n_sup"))
        .crossJoin(customer.agg(F.count(F.lit(1)).alias("n_cust"), F.min("c_custkey").alias("min_cust"))))
    sup = supplier.select("s_suppkey", "s_name", "s_nationkey")
    nat = broadcast_if_small(nation.select("n_nationkey", "n_name"))
    cust = customer.select("c_custkey", "c_name")

    docs = (documents.select("doc_id", "text", "source")
            .crossJoin(counts)
            .withColumn("__sk", d % F.col("n_sup"))
            .withColumn("__ck", d % F.col("n_cust") + F.col("min_cust")))
    j = (docs.join(sup, F.col("__sk") == F.col("s_suppkey"), "left")
             .join(nat, F.col("s_nationkey") == F.col("n_nationkey"), "left")
             .join(cust, F.col("__ck") == F.col("c_custkey"), "left"))

    sk = F.col("s_suppkey")
    agency = F.concat(F.col("s_name"),
                      F.when(sk % 4 == 0, AGENCY_SUFFIX[0]).when(sk % 4 == 1, AGENCY_SUFFIX[1]).otherwise(""))
    rating = F.when(d % 37 == 36, F.lit(3.5)).otherwise((F.lit(1) + (d * 7 + sk) % 5).cast("double"))
    iso = F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (d * 13 % DAY_SPAN).cast("int")), "yyyy-MM-dd")
    review_date = F.when(d % 17 == 0, F.lit(RELATIVE_DATE)).otherwise(iso)
    text = F.col("text")

    def row(rating, day, words):
        return F.struct(rating.cast("double").alias("rating"), day.cast("string").alias("review_date"),
                        words.alias("review_text"))

    # every document once, untouched; further rows of some documents give each rule something to do
    copy_day = F.when(d % 20 != 0, F.lit(FIRST_DAY))
    variants = F.array(
        row(rating, review_date, text),
        F.when(d % 10 == 0, row(rating, copy_day, F.concat(F.lit("  "), F.replace(text, F.lit("e"), F.lit("E")), F.lit(" ")))),
        F.when(d % 41 == 40, row(rating, review_date, F.lit("   "))),
        F.when(d % 23 == 22, row(rating, review_date, F.concat(F.lit(ARABIC_REVIEW), d.cast("string")))),
        F.when(d % 31 == 30, row(F.lit(None), review_date, text)),
        F.when(d % 29 == 28, row(F.lit(0.0), review_date, text)))
    return (j.select(d.alias("doc_id"), F.col("source").alias("bank"), agency.alias("agency"),
                     F.concat(F.lit(URL_PREFIX), sk.cast("string")).alias("url"), F.col("n_name").alias("location"),
                     F.col("c_name").alias("author"), F.explode(F.filter(variants, lambda v: v.isNotNull())).alias("v"))
             .select("doc_id", "bank", "agency", "url", "location", "author", "v.rating", "v.review_date", "v.review_text"))


def annotations_fixture(stg: DataFrame, labels: DataFrame) -> DataFrame:
    lab = labels.select("doc_id", "quality", "toxic")
    return (stg.select("review_id", "doc_id").join(lab, "doc_id", "inner")
               .select("review_id",
                       F.lit(None).cast("string").alias("feedback_category"),
                       F.lit(None).cast("string").alias("business_segment"),
                       F.when(F.col("quality") == 1, "high").otherwise("low").alias("review_quality"),
                       F.when(F.col("toxic") == 1, "priorite_haute").otherwise("normale").alias("action_priority")))
