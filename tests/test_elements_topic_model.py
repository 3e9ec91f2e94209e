"""Repeated review elements and the checked topic model."""

import time

import numpy as np
import pytest
from support import rows

from avisflow.operators.elements import marked_elements, nested_fields
from avisflow.plans import collect, topic_model

FIELDS = collect.REVIEW_FIELDS


def found(html):
    return list(nested_fields(html, collect.REVIEW_ELEMENTS, FIELDS))


def test_fields_stay_inside_their_review():
    html = ('<div class="jftiEf a"><div><div class=d4r55>A</div></div><div class="wiI7pd"><div>one <div>two</div></div> three</div></div>'
            '<div class="jftiEf"><span aria-label="4 stars"></span></div>'
            "<div class='b jftiEf'><span class='rsqaWe'>hier</span><div class='wiI7pd'>last")
    a, b, c = found(html)
    assert a == [["A", None, None], [None, None, None], [None, None], ["<div>one <div>two</div></div> three", None, None]]
    assert b == [[None] * 3, [None, None, "4 stars"], [None] * 2, [None] * 3]
    assert c[2] == ["hier", None] and c[3] == ["last", None, None]


def test_the_first_class_that_occurs_decides_and_nested_reviews_count():
    other = '<div class="gws-localreviews__google-review"><i class="d4r55">B</i></div>'
    inner = '<div class="jftiEf">x<div class="jftiEf"><i class="d4r55">C</i></div></div>'
    assert [f[0][0] for f in found(other)] == ["B"]
    assert [f[0][0] for f in found(other + inner)] == ["C", "C"]
    assert found("") == found("no tags < at all") == found("<div class='jftiEfx'></div>") == []


@pytest.mark.parametrize("html,classes", [
    ("<!-- <p class=a> --><p class=b>", [{"b"}]), ("<script>'<p class=a>'</script><p class=b>", [{"b"}]), ("<!-- <p class=a><p class=b>", [{"b"}]),
    ("<style><p class=b>", [{"b"}]), ("<p class=\"a b\" ><br class=\"c\"/>", [{"a", "b"}, {"c"}]), ("<p class=''>", [set()]), ("<p class=a", []), ("</p><p CLASS=b></q>", [{"b"}])])
def test_tags_that_are_none_or_never_end(html, classes):
    assert [e[2] for e in marked_elements(html)] == classes


def test_long_pages_take_time_in_proportion():
    start = time.perf_counter()
    for html in ("</div>" * 100_000, "<div class=a>" * 100_000, "<!--" * 100_000, "<script>" * 100_000, "<" * 300_000,
                 '<div class="jftiEf"><i class="d4r55">x</i></div>' * 20_000):
        found(html)
    assert time.perf_counter() - start < 30


def test_page_reviews_keeps_reviews_with_author_or_text(spark):
    pages = spark.createDataFrame([
        (1, "http://a/", '<div class="jftiEf"><b class="d4r55"> <i></i></b><b class="review__author">Zoé &amp; Cie</b><i class="kvMYJc" aria-label="3,5 étoiles"></i></div>'
                         '<div class="jftiEf"><i aria-label="aucune star"></i><b class="rsqaWe">2024</b></div><div class="jftiEf"><p class="wiI7pd"> a<br>b </p></div>'),
        (2, "http://a/", None), (3, "http://b/", "")], "page_id long, url string, html string")
    assert rows(collect.page_reviews(pages)) == [
        (1, 0, "Zoé & Cie", "3.5", "Non spécifié", "Non spécifié"), (1, 2, "Anonyme", "Non spécifié", "Non spécifié", "a b")]
    assert rows(collect.page_review_counts(pages)) == [(None, 2, 1), ("http://a", 2, 0)]


def topic_docs(spark, texts):
    return spark.createDataFrame([(f"r{i}", "en", t, len(texts)) for i, t in enumerate(texts)], "review_id string, language string, lda_text string, n_documents long")


def vocabulary(spark, terms):
    return spark.createDataFrame([("en", t, 2, 2, 1.0 + i / 4, i + 1) for i, t in enumerate(terms)],
                                 "language string, term string, df long, tf long, idf double, term_rank int")


def test_weights_have_norm_one_and_count_bigrams(spark):
    docs = topic_docs(spark, ["cash card cash", "nothing known", "cash card"])
    got = topic_model.document_weights(docs, vocabulary(spark, ["cash", "card", "cash card"])).collect()
    by = {(r["review_id"], r["term"]): (r["tf"], r["weight"]) for r in got}
    assert {k[0] for k in by} == {"r0", "r2"} and by["r0", "cash"][0] == 2 and by["r0", "cash card"][0] == 1
    raw = np.array([2 * 1.0, 1.25, 1.5])
    assert [by["r0", t][1] for t in ("cash", "card", "cash card")] == pytest.approx(raw / np.linalg.norm(raw), abs=1e-6)


def plain_fit(texts, terms, idf):
    """The same updates over dense arrays, written anew."""
    counts = np.array([[(t.split() + [" ".join(p) for p in zip(t.split(), t.split()[1:])]).count(x) for x in terms] for t in texts], float) * idf
    norm = np.linalg.norm(counts, axis=1, keepdims=True)
    n = np.round(np.divide(counts, norm, out=np.zeros_like(counts), where=norm > 0), 6)
    lam = np.array([[topic_model.start_weight(t, z) for t in terms] for z in range(5)])
    for step in range(topic_model.STEPS + 1):
        phi = lam / lam.sum(1, keepdims=True)
        theta = np.full((len(texts), 5), 0.2)
        for _ in range(topic_model.INNER):
            r = theta[:, :, None] * phi[None]
            r /= r.sum(1, keepdims=True)
            theta = (0.2 + (n[:, None] * r).sum(2)) / (1 + n.sum(1))[:, None]
        if step < topic_model.STEPS:
            r = theta[:, :, None] * phi[None]
            lam = 0.2 + (n[:, None] * r / r.sum(1, keepdims=True)).sum(0)
    return lam, theta


def test_fit_equals_the_plain_updates(spark):
    rng = np.random.default_rng(4)
    groups = [["cash", "card", "atm"], ["staff", "queue", "wait"], ["app", "site"]]
    texts = [" ".join(rng.choice(groups[i % 3], 12)) for i in range(60)] + [""]
    terms = [w for g in groups for w in g]
    topics, assigned = topic_model.fit(topic_docs(spark, texts).repartition(3), vocabulary(spark, terms))
    lam, theta = plain_fit(texts, terms, np.array([1.0 + i / 4 for i in range(len(terms))]))
    got = {r["review_id"]: (r["dominant_topic"], r["topic_confidence"]) for r in assigned.collect()}
    for i in range(len(texts)):
        assert got[f"r{i}"] == (int(np.round(theta[i], 9).argmax()), pytest.approx(theta[i].max(), abs=2e-6))
    assert got["r60"] == (0, pytest.approx(0.2))
    by_group = [{got[f"r{i}"][0] for i in range(60) if i % 3 == g} for g in range(3)]
    assert not by_group[0] & by_group[1]  # texts without common words share no topic
    for r in topics.collect():
        want = sorted(range(len(terms)), key=lambda i: (-round(lam[r["topic_id"]][i], 9), terms[i]))
        assert r["keywords"] == [terms[i] for i in want][:10] and r["weight_sum"] == pytest.approx(lam[r["topic_id"]].sum(), abs=1e-5)


def test_fit_without_vocabulary(spark):
    topics, assigned = topic_model.fit(topic_docs(spark, ["a b", "c"]), vocabulary(spark, []))
    assert topics.count() == 0 and {(r["dominant_topic"], r["topic_confidence"]) for r in assigned.collect()} == {(0, 0.2)}
