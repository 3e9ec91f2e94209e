"""The batched LDA against Spark ML's online optimizer, pass for pass."""

import random

import numpy as np
import pytest
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors

from avisflow.operators import online_lda
from avisflow.session import checkpointed

TERMS = [f"t{i}" for i in range(30)]
IDF = [1 + i / 30 for i in range(30)]


def documents(spark, n=400, parts=5):
    rng = random.Random(1)
    data = [(f"r{i:03d}", [TERMS[min(29, int(rng.expovariate(0.2)) + i % 5 * 4)] for _ in range(rng.choice([0, 5, 50]))]) for i in range(n)]
    data += [("r9", ["t1"] * 300 + ["t2"] * 70_000), ("s1", ["unknown", "t3"]), ("s2", None)]  # numbers of two and four bytes
    return spark.createDataFrame(data, "review_id string, terms array<string>").repartition(parts, "review_id").sortWithinPartitions("review_id")


def counted(docs):
    rows = online_lda.count_rows(docs.selectExpr("review_id", "'en' AS language", "terms"), "review_id", "language", "terms", {"en": TERMS})
    return checkpointed(online_lda.placed(rows))


def by_id(df, *columns):
    rows = {r[0]: tuple(r)[1:] for r in df.select("review_id", *columns).collect()}
    return [rows[k] for k in sorted(rows)]


@pytest.mark.parametrize("sizes", [{}, {"TOGETHER": 16, "MOVED": 4, "FEATURED": 50, "DOCS_A_TASK": 100}])
def test_equal_to_spark_ml(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(online_lda, name, value)
    docs = documents(spark)
    tf = CountVectorizerModel.from_vocabulary(TERMS, inputCol="terms", outputCol="tf").transform(docs.na.drop().unionByName(docs.where("terms is null").selectExpr(
        "review_id", "cast(array() as array<string>) AS terms")).repartition(5, "review_id").sortWithinPartitions("review_id"))
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(IDF), inputCol="tf", outputCol="scaled").transform(tf)
    feats = checkpointed(Normalizer(p=2.0, inputCol="scaled", outputCol="features").transform(scaled).select("review_id", "features"))
    theirs = LDA(k=3, maxIter=4, seed=42, optimizer="online", subsamplingRate=1.0, topicDistributionCol="d").fit(feats)
    rows = counted(docs)
    ours = online_lda.fit(rows, IDF, 3, 4, 42)
    assert np.allclose(ours.topics, theirs.topicsMatrix().toArray().T, rtol=1e-7, atol=0)
    assert np.allclose(ours.alpha, theirs.estimatedDocConcentration().toArray(), rtol=1e-7)
    for (words, weights), r in zip(ours.described(10), theirs.describeTopics(10).orderBy("topic").collect()):
        assert words == r["termIndices"] and np.allclose(weights, r["termWeights"], rtol=1e-7)
    expected = by_id(theirs.transform(feats).withColumn("a", vector_to_array("d")), "a")
    got = by_id(online_lda.assign(rows, "review_id", IDF, ours), "topic", "share")
    for (topic, share), (a,) in zip(got, expected, strict=True):
        assert topic == a.index(max(a)) and abs(share - max(a)) < 1e-7


def test_documents_are_inferred_together(monkeypatch):
    calls, one = [], online_lda.exp_digamma
    monkeypatch.setattr(online_lda, "exp_digamma", lambda x: calls.append(x.shape[1]) or one(x))
    rng = np.random.default_rng(3)
    docs, beta, alpha = online_lda.features(rng.integers(0, 5, (3000, 20)), np.ones(20)), rng.random((4, 20)), np.full(4, 0.25)
    start = np.tile(online_lda.gammas(1 << 40, 4)[:, None], (1, len(docs)))
    together = online_lda.infer(docs, start, beta, alpha)
    assert len(calls) < 1000  # one by one each document takes dozens
    alone = np.hstack([online_lda.infer(docs[i:i + 1], start[:, i:i + 1], beta, alpha) for i in range(0, 3000, 100)])
    assert np.allclose(together[:, ::100], alone, rtol=1e-12)


def test_no_documents_with_words(spark):
    docs = spark.createDataFrame([(f"r{i}", ["x"]) for i in range(12)], "review_id string, terms array<string>")
    rows = counted(docs)
    model = online_lda.fit(rows, IDF, 3, 2, 42)
    assert np.allclose(model.alpha, 1 / 3)
    assert {tuple(r)[1:] for r in online_lda.assign(rows, "review_id", IDF, model).collect()} == {(0, 0.0)}
