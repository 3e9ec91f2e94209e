"""SRC-1: raw review CSV (headered, quoted, texts with newlines) -> staging schema."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from avisflow.session import materialized_table

log = logging.getLogger(__name__)

RAW_COLUMNS = ("bank", "agency", "url", "location", "author", "rating", "date", "text")
RAW_CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])
CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"', "encoding": "UTF-8"}


def to_staging(raw: DataFrame) -> DataFrame:
    """Rename date/text to review_date/review_text; a rating that is not a number (the
    collector's 'Non spécifié' sentinel) becomes null instead of failing under ANSI mode."""
    return raw.select("bank", "agency", "url", "location", "author",
                      F.col("rating").try_cast("double").alias("rating"),
                      F.col("date").alias("review_date"), F.col("text").alias("review_text"))


def read_reviews_csv(spark: SparkSession, path: str) -> DataFrame:
    """Explicit schema (no inference pass over the data); multiLine keeps quoted newlines."""
    return to_staging(spark.read.schema(RAW_CSV_SCHEMA).options(**CSV_OPTIONS).csv(path))


CORRUPT = "_corrupt_record"
NO_RATING = "Non spécifié"  # fixed value: what the collector writes where a review has no rating
RECORD_OPTIONS = {"quoteAll": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false",
                  "ignoreTrailingWhiteSpace": "false"}


def _reason() -> Column:
    """Why a raw row cannot be staged; null for a good one. ``fields``: not as many fields as the
    format has; ``header``: a header repeated among the rows (files put together); ``rating``: a
    rating that is neither a number, missing nor the sentinel."""
    header = F.lit(True)
    for c in RAW_COLUMNS:
        header = header & F.col(c).eqNullSafe(c)
    return (F.when(F.col(CORRUPT).isNotNull(), "fields").when(header, "header")
             .when(F.col("rating").isNotNull() & (F.col("rating") != NO_RATING)
                   & F.col("rating").try_cast("double").isNull(), "rating"))


def read_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Staged reviews and quarantined rows (reason, record) of the raw CSV files under ``path``.

    The files are parsed once into a table of the shared folder, which both results read: the
    parser only sees a wrong number of fields while it reads every column. A missing path raises
    FileNotFoundError; files without any row give two empty results and a warning. A quarantined
    record of a wrong number of fields is its text in the file; others are written again as CSV."""
    schema = T.StructType([*RAW_CSV_SCHEMA.fields, T.StructField(CORRUPT, T.StringType(), True)])
    try:
        raw = (spark.read.schema(schema).options(**CSV_OPTIONS)
                    .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no review file at {path}") from exc
        raise
    parsed = materialized_table(raw.withColumn("reason", _reason()), "raw_reviews")
    if parsed.isEmpty():
        log.warning("no review in %s", path)
    kept = to_staging(parsed.where(F.col("reason").isNull()))
    record = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*RAW_COLUMNS), RECORD_OPTIONS))
    return kept, parsed.where(F.col("reason").isNotNull()).select("reason", record.alias("record"))
