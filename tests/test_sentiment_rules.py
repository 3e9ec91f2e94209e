"""Rule-based sentiment, one sentence at a time."""

import pytest
from support import rows

from avisflow.functions import sentiment_rules as R
from avisflow.plans import sentiment_rules as S

WEIGHTS = dict(R.WORD_WEIGHTS)
MODS = {k: {w: v for w, kind, v in R.MODIFIERS if kind == k} for k in ("booster", "negator", "contrast")}
ENTRIES = {p: (a, b, c) for p, a, b, c in R.PHRASES}


@pytest.mark.parametrize("text,total", [
    ("", 0.0), ("nothing here", 0.0), ("good", 1.5), ("GOOD", 1.5), ("GOOD bank", 2.0), ("very good", 1.75), ("very a good", 1.5 + 0.1875),
    ("very a b good", 1.5 + 0.125), ("very a b c good", 1.5), ("barely good", 1.25), ("very bad", -2.25), ("not good", -1.125), ("not a b good", -1.125),
    ("not a b c good", 1.5), ("not very good", -0.75 * 1.75), ("good but slow", 0.75 - 2.25), ("but good", 2.25), ("good!", 1.75), ("bad!!", -2.5),
    ("good!!!!!!", 2.5), ("good?", 1.5), ("good??", 1.75), ("good?????", 2.0), ("!!!", 0.0), ("très bon, mais lent", 0.5 * 1.75 - 1.5 * 1.625), ("good_bad", -0.5), ("ÉTÉ good 123", 1.5)])
def test_word_rules(text, total):
    assert S.word_scores(text, WEIGHTS, MODS)[0] == total


@pytest.mark.parametrize("text,found", [
    ("", (0.0, 0.0, 0)), ("good", (0.75, 0.625, 1)), ("not bad", (0.375, 0.5, 1)), ("bad", (-0.75, 0.6875, 1)), ("not good", (-0.375, 0.625, 1)),
    ("a waste of time", (-0.75, 0.875, 1)), ("waste of good time", (0.75, 0.625, 1)), ("very good", (0.9375, 0.875, 2)), ("very a good", (0.75, 0.875, 2)),
    ("extremely great", (1.0, 1.5, 2)), ("very not bad", (0.46875, 0.75, 2)), ("top notch top", (0.9375, 0.75, 1)), ("Pas mal du tout", (0.375, 0.5, 1)),
    ("pas bon", (-0.25, 0.5, 1)), ("not bad good", (1.125, 1.125, 2))])
def test_longest_match_walk(text, found):
    assert S.phrase_walk(text, ENTRIES, 3, set(MODS["negator"])) == found


def test_tables_of_ones_own_and_odd_rows(spark):
    texts = spark.createDataFrame([(1, "alpha beta"), (2, None), (3, ""), (4, "GAMMA alpha !")], "review_id long, review_text string")
    weights = spark.createDataFrame([("alpha", 3.0)], "word string, weight double")
    modifiers = spark.createDataFrame([("gamma", "booster", 1.0)], "word string, kind string, value double")
    got = rows(S.rule_scores(texts, weights, modifiers))
    assert [(r[0], r[5]) for r in got] == [(1, 1), (2, 0), (3, 0), (4, 1)] and got[1][1:5] == (0.0, 0.0, 0.0, 0.0)
    assert got[3][1] == pytest.approx(4.25 / (4.25 ** 2 + 15) ** 0.5, abs=1e-4)
    phrases = spark.createDataFrame([("alpha beta", -1.0, 1.0, 1.0)], "phrase string, polarity double, subjectivity double, intensity double")
    assert rows(S.phrase_scores(texts, phrases, modifiers)) == [(1, -1.0, 1.0, 1), (2, 0.0, 0.0, 0), (3, 0.0, 0.0, 0), (4, 0.0, 0.0, 0)]
    assert S.rule_scores(texts.where("false"), weights, modifiers).count() == 0


def test_tables_beyond_the_broadcast_bound_are_refused(spark, monkeypatch):
    monkeypatch.setattr(S, "MOST_ENTRIES", 3)
    with pytest.raises(ValueError):
        S.rule_scores(spark.createDataFrame([], "review_id long, review_text string"), *S.default_tables(spark)[:2])
