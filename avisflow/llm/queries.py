"""The registered queries of the training-data operators: thin, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from avisflow.llm import (block_naming, embedding_dups, html_text, lines, lm, mixing, phrases, piece_bpe, quality, secret_scan, simhash,
                          toxicity, vector_codes)
from avisflow.llm.common import read

PIECE_MODEL = "piece_bpe_32k.model"


def sha256(column):
    return F.lower(F.sha2(column, 256))


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_text.extract_pages(read(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_naming.exact_dedup(read(spark, sf_dir, "documents"))


def op3_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dups.near_duplicates(read(spark, sf_dir, "embeddings"))


def op4_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(read(spark, sf_dir, "documents").select("doc_id", "text"))


def encoded(docs: DataFrame) -> DataFrame:
    """Digests of the ids and of the text decoded from them."""
    out = piece_bpe.encode_decode(docs, public_tokenizers.path(PIECE_MODEL))
    rest = [c for c in docs.columns if c != "text"]
    return out.select(*rest, (F.length("ids") / 4).cast("long").alias("n_tokens"), sha256(F.col("ids")).alias("ids_sha256"),
                      sha256(F.col("decoded")).alias("decoded_sha256"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan_secrets(read(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_scan.RULES[:secret_scan.BASE]]

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return out.select("doc_id", *[count(k) for k in base],
                      sha256(joined(F.filter("spans", lambda s: s["kind"].isin(base)))).alias("base_sha256"),
                      joined(F.col("spans")).alias("spans"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", sha256(F.col("kept_text")).alias("kept_sha256"))


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(read(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    fitted = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, fitted).select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.with_label_errors(*vector_codes.compress(read(spark, sf_dir, "embeddings")))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_html_text, op2_exact_dedup, op3_embedding_dups, op4_piece_bpe, op5_secret_scan, op6_quality,
                                   op7_mixing, op8_simhash, op9_line_dedup, op10_lm, op11_toxicity,
                                   op12_vector_codes, op13_phrases, pipeline)}
