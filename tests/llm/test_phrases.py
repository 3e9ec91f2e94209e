"""Phrases against a plain count of all phrases; shards, broadcast and join give the same."""

import random
import re
from collections import Counter

import pytest
from llm_helpers import lower, odd_docs

from avisflow.llm import phrases


def plain(rows, support, longest=5, cover=100, top=2000):
    """rows: (lang, text)."""
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = [x for x in re.split(r"[\x20\x09]", piece) if x]
            n[lang] += len(w)
            f.setdefault(lang, Counter()).update(tuple(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: c for p, c in counts.items() if len(p) > 1 and c >= support}
        covered = set()
        for p, c in found.items():
            for k in range(2, len(p)):
                covered |= {p[i:i + k] for i in range(len(p) - k + 1) if 100 * c >= cover * counts[p[i:i + k]]}
        scored = []
        for p, a in found.items():
            if p not in covered:
                score, _, left, right = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def run(spark, rows, support, parts=3, **options):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(parts)
    got = phrases.collocations(df, support=support, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def corpus(n, seed=1):
    rng, words = random.Random(seed), [f"w{i}" for i in range(12)] + ["Été", "日本", "\0x", "a-b"]
    out = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" "] * 8 + ["  ", "\t", ".", ", ", "\n", "!?"]) for _ in range(rng.randrange(0, 60)))
        out.append((rng.choice(["en", "en", "de", None, "und"]), text + rng.choice(["", " Deep Red Sea of glass", " new York"])))
    return out + [("en", out[0][1])] * 30  # copies


@pytest.mark.parametrize("options", [{}, {"shard_words": 300}, {"shard_words": 50}, {"held_phrases": 0}, {"held_phrases": 0, "shard_words": 200},
                                     {"longest": 3}, {"top": 5}, {"cover": 60}])
def test_equal_to_the_plain_count(spark, options):
    rows = corpus(260)
    assert run(spark, rows, 9, **options) == plain(rows, 9, **{k: v for k, v in options.items() if k in ("longest", "top", "cover")})


def test_one_long_text_and_one_long_piece(spark, monkeypatch):
    rng = random.Random(2)
    rows = [("en", " ".join(rng.choice("abcdef") for _ in range(30000))), ("en", ". ".join(" ".join(rng.choice("abc") for _ in range(7)) for _ in range(4000)))]
    monkeypatch.setattr(phrases, "_CUT", 1000)
    assert run(spark, rows, 40, shard_words=2000) == plain(rows, 40)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    got = sorted(tuple(r) for r in phrases.collocations(docs, support=3).collect())
    assert got == plain(rows, 3) and any(p == "the same text" for _, _, p, *_ in got)
    assert phrases.collocations(docs.where("false"), support=3).count() == 0
    assert phrases.collocations(docs.where("text is null"), support=1).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 10 ** 12
    f = spark.createDataFrame([("en", "a b", big), ("en", "a", 2 * big), ("en", "b", 3 * big)], "lang string, phrase string, f long")
    n = spark.createDataFrame([("en", 10 ** 15)], "lang string, n long")
    phrases_of = phrases.frequent_phrases
    try:
        phrases.frequent_phrases = lambda *a, **k: (f, n)
        (row,) = phrases.collocations(spark.createDataFrame([], "lang string, text string")).collect()
    finally:
        phrases.frequent_phrases = phrases_of
    assert row["score"] == 1000 * big * 10 ** 15 // (6 * big * big)


def test_what_is_written_does_not_follow_the_number_of_shards(spark, monkeypatch):
    rng, sizes, table = random.Random(4), {}, phrases.table
    rows = [("en", " ".join(f"w{rng.randrange(40)}" for _ in range(100)) + " as well as") for _ in range(200)]

    def counted(df, name):
        sizes[name] = max(sizes.get(name, 0), (out := table(df, name)).count())
        return out

    monkeypatch.setattr(phrases, "table", counted)
    assert run(spark, rows, 30, shard_words=200) == plain(rows, 30)
    assert max(sizes.values()) < 3000, sizes  # nearly all runs of three or more words are rare, and there are far more of them


def test_small_rows_and_parts(spark, monkeypatch):
    rows = corpus(120)
    for name, value in (("ROW_PLACES", 7), ("COUNTED_WORDS", 5), ("CODED_WORDS", 100)):
        monkeypatch.setattr(phrases, name, value)
    assert run(spark, rows, 6, held_phrases=40, shard_words=500) == plain(rows, 6)
