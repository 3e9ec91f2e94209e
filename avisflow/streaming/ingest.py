"""Incremental ingest of review CSV drops into the raw table with Structured Streaming.

The daily batch append (SNK-1) as a file-source stream: each run picks up only files not yet
seen (tracked in the checkpoint), appends them to the partitioned raw table, and stops
(``Trigger.AvailableNow``). Exactly-once: the file sink commits through its own log.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from avisflow.sources.reviews_csv import CSV_OPTIONS, RAW_CSV_SCHEMA, to_staging
from avisflow.sources.sinks import append_batch


def ingest_batches(spark: SparkSession, source_dir: str, staging_path: str, checkpoint: str, ingest_date: dt.date,
                   stream: str = "stream", max_files_per_trigger: int | None = None) -> None:
    """The same stream into batches that may be replayed: a micro-batch owns the partition of its
    stream and number, so one that ran before its commit was lost (or a stream that starts again
    without its checkpoint) replaces its own rows instead of adding them again."""
    reader = spark.readStream.schema(RAW_CSV_SCHEMA).options(**CSV_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))

    def store(batch: DataFrame, number: int) -> None:
        append_batch(batch, staging_path, ingest_date, f"{stream}-{number:012d}")

    q = (to_staging(reader.csv(source_dir)).writeStream.foreachBatch(store)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def ingest_available(spark: SparkSession, source_dir: str, staging_path: str, checkpoint: str,
                     max_files_per_trigger: int | None = None) -> None:
    reader = spark.readStream.schema(RAW_CSV_SCHEMA).options(**CSV_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = to_staging(reader.csv(source_dir)).withColumn("ingest_date", F.current_date())
    q = (stream.writeStream.format("parquet")
               .option("path", staging_path)
               .option("checkpointLocation", checkpoint)
               .partitionBy("ingest_date")
               .outputMode("append")
               .trigger(availableNow=True)
               .start())
    q.awaitTermination()
