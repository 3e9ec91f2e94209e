"""Counts of words and word pairs, and the vocabulary that comes from them."""

import random
from collections import Counter

import pytest
from support import rows

from avisflow.operators import terms
from avisflow.plans import topic_model, topics


def texts_of(n, words, seed=3):
    rng = random.Random(seed)
    return [" ".join(rng.choice(words) for _ in range(rng.randint(1, 12))) for _ in range(n)]


def docs_of(spark, by_language):
    data = [(f"{g}{i}", g, t, len(ts)) for g, ts in by_language.items() for i, t in enumerate(ts)]
    return spark.createDataFrame(data, "review_id string, language string, lda_text string, n_documents long").repartition(3)


def plain(texts):
    tf, df = Counter(), Counter()
    for t in texts:
        words = t.split(" ")
        both = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        tf.update(both)
        df.update(set(both))
    able = [t for t in tf if 2 <= df[t] <= 0.8 * len(texts)]
    return [(t, df[t], tf[t]) for t in sorted(able, key=lambda t: (-tf[t], t))[:topics.MAX_FEATURES]]


# few words: all pairs can lead; many: only some; "aaa" is in nearly every text and leads none, its pairs may
@pytest.mark.parametrize("n_words", [4, 60, 400])
@pytest.mark.parametrize("limit", [None, 5])
def test_vocabulary_equals_counts_of_all_terms(spark, monkeypatch, n_words, limit):
    if limit:
        monkeypatch.setattr(topics, "PAIR_WORDS", limit)  # more words than that: all pairs are counted
    words = [f"w{i:03d}" for i in range(n_words)]
    by = {"en": [f"aaa {t}" for t in texts_of(300, words)], "fr": [t for t in texts_of(80, words[:9], 5)], "ar": ["one text"] * 9}
    got = topics.vocabulary_of(docs_of(spark, by)).collect()
    for language in ("en", "fr"):
        found = sorted((r["term_rank"], r["term"], r["df"], r["tf"]) for r in got if r["language"] == language)
        assert found == [(i + 1, *x) for i, x in enumerate(plain(by[language]))]
    assert not [r for r in got if r["language"] == "ar"]  # too few documents


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(terms, "HELD", 10)
    monkeypatch.setattr(terms, "TEXTS_AT_ONCE", 2)
    texts = texts_of(40, ["aaa", "bbb", "ccc", "ddd"])
    docs = docs_of(spark, {"en": [*texts, ""]})
    tf, df = Counter(w for t in texts for w in t.split()), Counter(w for t in texts for w in set(t.split()))
    assert rows(terms.word_counts(docs, "language", "lda_text")) == sorted(("en", w, tf[w], df[w]) for w in tf)


def test_weights_move_no_row(spark):
    docs = docs_of(spark, {"en": ["cash card cash", ""], "xx": ["cash"]})
    vocab = spark.createDataFrame([("en", "cash", 1.0, 1), ("en", "cash card", 2.0, 2)], "language string, term string, idf double, term_rank int")
    weights = topic_model.document_weights(docs.coalesce(1), vocab)
    assert rows(weights) == [("en0", "en", "cash", 1, 2, 0.707107), ("en0", "en", "cash card", 2, 1, 0.707107)]
    assert "hashpartitioning" not in weights._jdf.queryExecution().executedPlan().toString()


def test_scores_are_computed_where_texts_are_read(spark):
    from support import SF_SMALL

    from avisflow.plans import sentiment, staging
    from avisflow.plans.warehouse import TEXT_COLUMNS, Warehouse

    def scored(df):
        return topics.with_keyword_topic(sentiment.with_scores(df, "clean_text"))

    raw = Warehouse(spark, SF_SMALL).staging_reviews
    early = staging.stg_reviews(raw, scored, TEXT_COLUMNS)
    late = scored(staging.stg_reviews(raw)).drop(*TEXT_COLUMNS)
    plan = Warehouse(spark, SF_SMALL, materialize=True)._jobs  # the written table has no text either
    assert early.columns == late.columns == plan.columns and rows(early) == rows(late) == rows(plan)
    shuffled = early._jdf.queryExecution().optimizedPlan().toString().split("+- Project")[0]
    assert "Window" in shuffled and "clean_text" not in shuffled


def test_lexicon_words_meet_the_word_before(spark):
    from avisflow.plans import sentiment

    docs = spark.createDataFrame([(1, "not good, good never bad"), (2, "never never"), (3, ""), (4, None), (5, "plain words")], "i long, t string")
    got = {r["i"]: (r["lexicon_hits"], r["textblob_polarity"]) for r in sentiment.with_scores(docs, "t").collect()}
    assert got[1] == (4, round((-1.5 + 1.5 - 0.5 + 2.0) / 4 / 3.5, 4)) and got[2] == (2, 0.0) and got[3] == got[5] == (0, 0.0)


def test_trigrams_are_numbers_of_code_points():
    from avisflow.plans.sentiment import _trigrams

    assert len(_trigrams("ab")) == len(_trigrams(None)) == 0 and len(_trigrams("aé𝒜x")) == 2
    assert len(set(_trigrams("abcabc").tolist())) == 3
