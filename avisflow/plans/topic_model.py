"""NLP-8 document weights and NLP-9..13 as an exactly reproducible topic model.

* ``document_weights``: the sparse document x term matrix of the vocabulary, tf * idf with L2 norm 1
  per document. The vocabulary (at most ``MAX_FEATURES`` terms per language) goes to every task, which
  counts and weighs its own documents: nothing is shuffled.
* ``fit``: batch expectation-maximisation of a topic mixture with Dirichlet smoothing. Every step
  starts each document from equal topic shares, updates them ``INNER`` times under the current
  topics and adds up the expected term weights; topics start from hashes of the terms, so reruns and
  other engines agree. A step is one map over the written matrix and a sum of at most topics x terms
  numbers per task, summed before the shuffle; topics (topics x vocabulary) are all the driver holds.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from avisflow.functions.numeric import pg_round
from avisflow.operators.terms import known_terms
from avisflow.plans.topics import N_TOPICS, TOP_WORDS, argmax, category_scores, joined_keywords
from avisflow.session import materialized_table

# ---------------------------------------------------------------------------
# Priors (one over the number of topics), steps of the fit, digits that decide ranks.
PRIOR = 1.0 / N_TOPICS
STEPS, INNER = 10, 3
DIGITS = 9
# ---------------------------------------------------------------------------


def vocabulary_terms(vocab: DataFrame) -> dict[str, list[str]]:
    """The terms per language (MAX_FEATURES at most each), in rank order."""
    terms: dict[str, list[str]] = {}
    for language, _, term in sorted((r["language"], r["term_rank"], r["term"]) for r in vocab.collect()):
        terms.setdefault(language, []).append(term)
    return terms


def _weighed(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """(review_id, language, ranks, terms, tfs, weights): one row per document, its vocabulary terms by rank
    and tf * idf over their norm, not yet rounded; empty arrays where no term is known."""
    listed = vocab.collect()  # MAX_FEATURES per language
    terms: dict[str, list[str]] = {}
    for r in listed:
        terms.setdefault(r["language"], []).append(r["term"])
    place = {(r["language"], r["term"]): (r["term_rank"], r["idf"]) for r in listed}
    known = known_terms(docs, "review_id", "language", "lda_text", terms, "known")

    def run(batches):
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for language, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                rows = sorted((*place[language, t], t, n) for t, n in Counter(found).items())
                raw = [n * idf for _, idf, _, n in rows]
                norm = math.sqrt(math.fsum(x * x for x in raw))
                for column, values in zip(columns, ([r for r, *_ in rows], [t for _, _, t, _ in rows], [n for *_, n in rows], [x / norm for x in raw])):
                    column.append(values)
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, pa.list_(k)) for c, k in zip(columns, kinds))],
                                             names=["review_id", "language", "ranks", "terms", "tfs", "weights"])

    kind = known.schema["review_id"].dataType.simpleString()
    return known.mapInArrow(run, f"review_id {kind}, language string, ranks array<int>, terms array<string>, tfs array<bigint>, weights array<double>")


def document_weights(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """(review_id, language, term, term_rank, tf, weight): one row per document and vocabulary term
    in it. Documents without a vocabulary term have no row."""
    rows = _weighed(docs, vocab)
    found = rows.select("review_id", "language", F.explode(F.arrays_zip("terms", "ranks", "tfs", "weights")).alias("w"))
    return found.select("review_id", "language", F.col("w.terms").alias("term"), F.col("w.ranks").alias("term_rank"),
                        F.col("w.tfs").alias("tf"), pg_round("w.weights", 6).alias("weight"))


def start_weight(term: str, topic: int) -> float:
    return 1.0 + int(hashlib.md5(f"{term}:{topic}".encode()).hexdigest()[:4], 16) / 65536.0


def _shares(batch, places: dict, topics: np.ndarray):
    """Topic shares of a batch's documents and, per entry of the matrix, (place, expected weights)."""
    ranks, weights = batch.column(2), batch.column(3)
    sizes = np.diff(np.asarray(ranks.offsets))
    row = np.repeat(np.arange(batch.num_rows), sizes)
    first = np.array([places.get(x, 0) for x in batch.column(1).to_pylist()], np.int64)
    at = first[row] + ranks.flatten().to_numpy(zero_copy_only=False) - 1
    n = weights.flatten().to_numpy(zero_copy_only=False)
    p, total = topics[at], np.bincount(row, n, batch.num_rows)
    shares = np.full((batch.num_rows, N_TOPICS), PRIOR)

    def expected():
        e = shares[row] * p
        return e * (n / e.sum(1))[:, None]

    for _ in range(INNER):
        e = expected()
        sums = np.stack([np.bincount(row, e[:, z], batch.num_rows) for z in range(N_TOPICS)], axis=1)
        shares = (PRIOR + sums) / (N_TOPICS * PRIOR + total)[:, None]
    return shares, at, expected()


def matrix(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """(review_id, language, ranks, weights): a row per document, empty arrays where no term is known."""
    rounded = F.transform("weights", lambda x: pg_round(x, 6))
    return materialized_table(_weighed(docs, vocab).select("review_id", "language", "ranks", rounded.alias("weights")), "topic_matrix")


def fit(docs: DataFrame, vocab: DataFrame, steps: int = STEPS) -> tuple[DataFrame, DataFrame]:
    """((language, topic_id, keywords, weight_sum), (review_id, language, dominant_topic,
    topic_confidence)). Documents without a vocabulary term have equal shares and topic 0."""
    spark = docs.sparkSession
    words = sorted((r["language"], r["term_rank"], r["term"]) for r in vocab.collect())  # MAX_FEATURES per language
    places: dict[str, int] = {}
    for i, (language, _, _) in enumerate(words):
        places.setdefault(language, i)
    group = np.array([places[x] for x, _, _ in words], np.int64)
    totals = np.array([[start_weight(term, z) for z in range(N_TOPICS)] for _, _, term in words]).reshape(-1, N_TOPICS)
    held = matrix(docs, vocab)

    def normalised():
        sums = np.stack([np.bincount(group, totals[:, z], len(words)) for z in range(N_TOPICS)], axis=1) if len(words) else totals
        return spark.sparkContext.broadcast(totals / sums[group])

    for _ in range(steps if len(words) else 0):
        topics = normalised()

        def step(batches, topics=topics):
            sums = np.zeros((len(words), N_TOPICS))
            for batch in batches:
                _, at, e = _shares(batch, places, topics.value)
                np.add.at(sums, at, e)
            at = np.flatnonzero(sums.sum(1))
            yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(sums[at, z]) for z in range(N_TOPICS))],
                                             names=["place", *(f"e{z}" for z in range(N_TOPICS))])

        found = held.mapInArrow(step, "place long, " + ", ".join(f"e{z} double" for z in range(N_TOPICS)))
        totals = np.full((len(words), N_TOPICS), PRIOR)
        for r in found.groupBy("place").agg(*[F.sum(f"e{z}").alias(f"e{z}") for z in range(N_TOPICS)]).collect():  # a row per vocabulary term
            totals[r["place"]] += [r[f"e{z}"] for z in range(N_TOPICS)]
    topics = normalised()

    def assign(batches):
        for batch in batches:
            shares = _shares(batch, places, topics.value)[0] if len(words) else np.full((batch.num_rows, N_TOPICS), PRIOR)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(shares), pa.list_(pa.float64()))],
                                             names=["review_id", "language", "shares"])

    kind = held.schema["review_id"].dataType.simpleString()
    shares = held.mapInArrow(assign, f"review_id {kind}, language string, shares array<double>")
    rounded = F.transform("shares", lambda x: F.round(x, DIGITS))
    assigned = shares.select("review_id", "language", argmax(rounded).alias("dominant_topic"), pg_round(F.array_max("shares"), 6).alias("topic_confidence"))
    ranked = []
    for language in places:
        own = [i for i, w in enumerate(words) if w[0] == language]
        for z in range(N_TOPICS):
            top = sorted(own, key=lambda i: (-round(totals[i, z], DIGITS), words[i][2]))[:TOP_WORDS]
            ranked.append((language, z, [words[i][2] for i in top], float(sum(totals[i, z] for i in top))))
    described = spark.createDataFrame(ranked, "language string, topic_id int, keywords array<string>, weight double")
    return described.select("language", "topic_id", "keywords", pg_round(F.col("weight"), 6).alias("weight_sum")), assigned


def topic_words(topics: DataFrame) -> DataFrame:
    """NLP-10 + NLP-12: the topics with their joined words, weight and category."""
    return category_scores(topics).select("language", "topic_id", joined_keywords("keywords").alias("topic_keywords"),
                                          F.array_join("keywords", ", ").alias("keywords"), "weight_sum", "category", "category_score", "category_confidence")
