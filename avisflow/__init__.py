"""avisflow — customer-review analytics on Spark.

Layers:
  functions/  column-expression builders (keys, text rules, dates, rounding, classifiers)
  operators/  reusable DataFrame operators (dedup, ranking, shares, size-checked broadcast, checks)
  sources/    readers and writers (driver parquet tables, review CSV, sinks)
  plans/      the models: fixture -> staging -> enriched -> star schema -> views -> quality,
              plus collection shaping, lexicon sentiment and topic extraction
  streaming/  incremental ingest of review files with Structured Streaming
"""

__version__ = "0.1.0"
