"""SNK-1..3: append, replace and CSV sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from avisflow.sources.versions import remove_old, replace_version

CSV_WRITE_OPTIONS = {"header": "true", "quoteAll": "true", "escape": '"', "encoding": "UTF-8",
                     "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


ROWS_PER_FILE = 100_000


def to_raw(staging: DataFrame) -> DataFrame:
    """Staging schema -> the collector's raw CSV columns (all text)."""
    return staging.select("bank", "agency", "url", "location", "author", F.col("rating").cast("string").alias("rating"),
                          F.col("review_date").alias("date"), F.col("review_text").alias("text"))


def write_reviews_csv(staging: DataFrame, path: str) -> None:
    """SNK-3: quoted, headered CSV (a directory of part files); whitespace kept verbatim. Files are
    bounded, since a reader that allows line feeds in fields reads each file in one task."""
    (to_raw(staging).write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE)
     .options(**CSV_WRITE_OPTIONS).csv(path))


def append_staging(batch: DataFrame, path: str, ingest_date: dt.date | None = None) -> None:
    """SNK-1: append a batch to the raw table, partitioned by ingest date (no key check, as
    in the reference; repeats are absorbed by the staging de-duplication)."""
    d = ingest_date or dt.date.today()
    batch.withColumn("ingest_date", F.lit(d)).write.mode("append").partitionBy("ingest_date").parquet(path)


def append_batch(batch: DataFrame, path: str, ingest_date: dt.date, batch_id: str) -> None:
    """SNK-1 that may be retried: a batch owns the partition (ingest_date, batch_id) and a repeated
    write replaces that partition alone, so the same batch sent twice is stored once."""
    (batch.withColumns({"ingest_date": F.lit(ingest_date), "batch_id": F.lit(batch_id)})
          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("ingest_date", "batch_id").parquet(path))


def replace_table(df: DataFrame, path: str) -> str:
    """SNK-2: replace a table (annotation tables, marts) by a new version; its folder. The earlier
    version stays current until the new one is whole, and is removed by the next replace but one."""
    folder = replace_version(df, path)
    remove_old(df.sparkSession, path, keep=2)
    return folder
