"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Each stage works on all that its predecessor kept and its decisions take effect: documents that the
quality classifier rejects go (none, where labels are too few or of one kind to fit it); of equal
texts one row of the largest doc_id stays; of each group of SimHash near-duplicates one row of the
smallest doc_id stays (null ids only where there is no other); the mix drops and repeats documents
to meet the sources' targets; the last stage encodes what is left and decodes it again (one row per copy in the mix).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from avisflow.llm import block_naming, mixing, quality, queries, simhash
from avisflow.llm.common import read, table


def _rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` written with a row number (and its name), so that decisions hold for rows: ids may be
    null or repeat."""
    name = "row"
    while name in docs.columns:
        name += "_"
    return table(docs.withColumn(name, F.monotonically_increasing_id()), "stage-rows"), name


def _without(docs: DataFrame, gone: DataFrame, row: str) -> DataFrame:
    """Rows of ``docs`` whose number is not in ``gone`` (one column, gone_row)."""
    return docs.join(gone.hint("shuffle_hash"), docs[row] == gone["gone_row"], "left_anti").drop(row)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    if not model["net"]["fitted"]:
        return docs  # nothing was learned: no reason to reject
    scored = quality.score(docs, model, score_name="quality_score", predicted_name="quality_predicted")
    return scored.where("quality_predicted = 1").select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, row = _rows(docs)
    key = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id"), F.col(row).alias("row"))  # null ids are never the largest
    found = block_naming.exact_dedup(docs.select(key.alias("key"), "text"), id_col="key")
    return _without(docs, table(found.where("not kept").select(F.col("doc_id.row").alias("gone_row")), "gone-exact"), row)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, row = _rows(docs)
    key = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id"), F.col(row).alias("row"))  # nor the smallest
    found = simhash.near_duplicates(docs.select(key.alias("key"), "text"), id_col="key")
    gone = found.where(F.col("doc_id.row") != F.col("component_id.row")).select(F.col("doc_id.row").alias("gone_row"))
    return _without(docs, table(gone, "gone-near"), row)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.encoded(docs.select("doc_id", "source", "text"))


STAGES = [("quality", quality_filter), ("exact_dedup", exact_dedup), ("simhash_dedup", simhash_dedup),
          ("mixing", source_mix), ("encode", encode)]
#: SQL can express neither the classifier nor the mix; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
