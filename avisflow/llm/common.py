"""Helpers shared by the training-data operators: intermediate tables, worker caches, Arrow columns."""

from __future__ import annotations

import sys
import types

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from avisflow.session import scratch_path

# Functions of this package travel to the executors by value, so a cluster needs no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

#: ASCII white space of the contracts: \x20 and \x09-\x0D; ``bytes.split``/``strip`` use the same set.
ASCII_SPACE = b" \t\n\x0b\x0c\r"


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts lineage, survives
    lost executors, and later joins see a plain scan whose skewed partitions Spark can split."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def worker_cache(key: str) -> dict:
    """A dictionary kept by the Python worker process between tasks."""
    home = sys.modules.setdefault("_avisflow_worker_cache", types.ModuleType("_avisflow_worker_cache"))
    return home.__dict__.setdefault("caches", {}).setdefault(key, {})


def text_bytes(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8 bytes; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if t is None else t for t in column.cast(kind).to_pylist()]


def slices(batch: pa.RecordBatch, column: int = -1, most: int = 8 << 20):
    """Cut a batch into runs of rows with at most ``most`` text bytes each (one row at least), so a
    task's memory does not follow the number of rows Spark put into a batch."""
    col = batch.column(column)
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    yield batch.slice(start)


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, fit_rows: int, held_out, seed: int) -> DataFrame:
    """(y, text): one row per id with one kind of label (0 or 1) and a document, at most about
    ``fit_rows`` however often tables repeat an id; of its rows the largest text."""
    known = (labels.select(F.col(id_col).alias("l_id"), F.col(label_col).alias("l_y"))
             .where(F.col("l_id").isNotNull() & F.col("l_y").isin(0, 1) & ~held_out("l_id"))
             .groupBy("l_id").agg(F.min("l_y").alias("y"), F.max("l_y").alias("y_most")).where("y = y_most").select("l_id", "y"))
    rate = min(1.0, fit_rows / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64(F.lit(seed), "l_id"), F.lit(1 << 30)) < int(rate * (1 << 30)))
    return (docs.select(F.col(id_col).alias("d_id"), F.col(text_col).alias("text"))
            .join(F.broadcast(known), F.col("d_id") == F.col("l_id"))  # about fit_rows ids
            .groupBy("l_id").agg(F.first("y").alias("y"), F.max(F.coalesce("text", F.lit(""))).alias("text")).select("y", "text"))


def crc_mod(id_column: str, modulus: int):
    """crc32 of the id written as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string")) % modulus


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
