"""Toxicity: the machine's value against the sum over all pairs, odd rows, held-out labels."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import odd_docs

from avisflow.llm import toxicity
from avisflow.llm.common import read


def slow_probability(text, fitted):
    """The value by its definition: every pair of terms on its own."""
    kept, model = fitted["kept"].tolist(), fitted["model"]
    words = "".join(c.lower() if "A" <= c <= "Z" else c if "a" <= c <= "z" or ord(c) > 127 else " " for c in text or "").split(" ")
    words = [w.encode() for w in words if w]
    sums = Counter()
    for w in words:
        for n in (None, 3, 4, 5, 6, 7):
            if n is None or len(w) > n:
                sums[zlib.crc32(w if n is None else str(n).encode() + b"\0" + w[:n]) % (1 << 18)] += 1
    terms = [(i, 2 / 3 * min(sums[p], 3)) for i, p in enumerate(kept) if sums[p]] + [(len(kept), (np.log1p(len(words)) - 5) / 1.5)]
    value = model["b"] + sum(model["w"][i] * x for i, x in terms)
    for a, (i, x) in enumerate(terms):
        for j, z in terms[a + 1:]:
            value += float(model["v"][i] @ model["v"][j]) * x * z
    return 1 / (1 + np.exp(-value))


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t, _ in rows], "doc_id long, text string, lang string, source string, n_chars long"), \
        spark.createDataFrame([(i, 1, y) for i, _, y in rows if y is not None], "doc_id long, quality int, toxic int")


def pair_rows(n):
    """Toxic only where an insult meets a group; each of them alone is harmless."""
    rng, rows = random.Random(3), []
    for i in range(n):
        words = [f"w{rng.choice('abcdefgh')}{rng.choice('klmnop')}" for _ in range(rng.randrange(5, 40))]
        kind = rng.choice(["both", "insult", "group", "none"])
        words += ["clown"] * (kind in ("both", "insult")) + ["martians"] * (kind in ("both", "group"))
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(kind == "both")))
    return rows


def test_pairs_are_learned_and_equal_the_slow_form(spark):
    rows = pair_rows(3000)
    docs, labels = table(spark, rows)
    fitted = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.score(docs, fitted).collect()}
    held = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(got[i]["predicted"] == y for i, y in held) / len(held) > 0.97  # an additive model gets one of four kinds wrong
    for i, t, _ in rows[:60]:
        assert got[i]["score"] == pytest.approx(slow_probability(t, fitted), abs=1e-9)


def test_held_out_labels_are_never_read(spark):
    rows = pair_rows(400)
    docs, labels = table(spark, rows)
    turned = table(spark, [(i, t, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, t, y in rows])[1]
    a, b = (toxicity.fit(docs, x)["model"] for x in (labels, turned))
    assert np.array_equal(a["w"], b["w"]) and np.array_equal(a["v"], b["v"]) and a["b"] == b["b"]


def test_odd_rows_and_few_labels(spark):
    docs = odd_docs(spark)
    _, labels = table(spark, [(1, "", 1), (1, "", 1), (2, "", 0), (3, "", 1), (3, "", 0), (None, "", 1), (4, "", 7), (16, "", 0), (99, "", 1)])
    out = toxicity.score(docs, toxicity.fit(docs, labels), score_name="s_", predicted_name="p_")
    got = out.collect()
    assert len(got) == docs.count() and out.columns == [*docs.columns, "s_", "p_"] and all(0 <= r["s_"] <= 1 for r in got)
    none = toxicity.fit(docs, labels.where("false"))
    assert {r["score"] for r in toxicity.score(docs.drop("score_"), none).collect()} == {0.5}
    assert toxicity.score(docs.where("false"), none).count() == 0
    with pytest.raises(ValueError):
        toxicity.score(docs, none, score_name="rid")


def test_repeated_ids_do_not_grow_the_sample(spark):
    rows = [(7, f"text {i}", None) for i in range(500)] + [(8, "x", None)]
    docs, _ = table(spark, rows)
    _, labels = table(spark, [(i, "", y) for i, y in [(7, 1)] * 20 + [(8, 0)] * 20])
    assert toxicity.labelled(docs, labels, "doc_id", "text", "toxic", 100).count() <= 2


def test_held_out_documents_of_the_given_table(spark):
    sf = "/root/testdata/sf0.1"
    from avisflow.llm.queries import op11_toxicity
    truth = {r["doc_id"]: r["toxic"] for r in read(spark, sf, "labels").collect()}
    got = [(truth[r["doc_id"]], r["predicted"]) for r in op11_toxicity(spark, sf).where("held_out").collect() if r["doc_id"] in truth]
    assert sum(p for y, p in got if y == 1) / sum(y for y, _ in got) > 0.85
    assert sum(p for y, p in got if y == 0) / sum(1 - y for y, _ in got) < 0.005
