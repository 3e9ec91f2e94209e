"""Driver test tables (one parquet file per table) and a lazy per-directory catalog."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; projection and filters applied later are pushed into the scan."""
    return spark.read.parquet(table_path(sf_dir, name))


class Catalog:
    """Name -> DataFrame for one data directory (plans stay lazy; nothing is read here)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
