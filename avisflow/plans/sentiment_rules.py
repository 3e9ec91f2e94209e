"""NLP-1 and NLP-2 by rules from tables.

* ``rule_scores``: every word's weight is changed by the words before it (boosters that fade with
  distance, negation), by its capitals and by its side of a contrast word; exclamation and question
  marks add to the sum.
* ``phrase_scores``: a walk that takes the longest entry at each place; an entry without polarity
  passes its intensity on to the entry that follows directly, a negator directly before turns it.

Both tables are DataFrames, so a user brings their own. They are dictionaries of words: checked
against ``MOST_ENTRIES`` and broadcast; texts are scored in a map and never shuffled.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from avisflow.functions import sentiment_rules as R
from avisflow.functions.lexicon import ALPHA
from avisflow.functions.numeric import pg_round

MOST_ENTRIES = 1_000_000
_WORD = re.compile(r"[^\W\d_]+")


def default_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(word, weight), (word, kind, value), (phrase, polarity, subjectivity, intensity)."""
    return (spark.createDataFrame(R.WORD_WEIGHTS, "word string, weight double"), spark.createDataFrame(R.MODIFIERS, "word string, kind string, value double"),
            spark.createDataFrame(R.PHRASES, "phrase string, polarity double, subjectivity double, intensity double"))


def _held(table: DataFrame) -> list:
    rows = table.limit(MOST_ENTRIES + 1).collect()
    if len(rows) > MOST_ENTRIES:
        raise ValueError(f"a word table may hold {MOST_ENTRIES} entries; this one is larger")
    return rows


def word_scores(text: str, weights: dict, modifiers: dict) -> tuple[float, float, float, int, int]:
    """(sum, positive part, negative part, words without weight, words with one) of a text."""
    words = _WORD.findall(text)
    low = [w.lower() for w in words]
    shouting = [len(w) > 1 and w.isupper() for w in words]
    capitals = not all(shouting)  # capitals say something only beside other words
    boosters, negators, contrasts = modifiers["booster"], modifiers["negator"], modifiers["contrast"]
    turn = next((i for i, w in enumerate(low) if w in contrasts), None)
    total = positive = negative = 0.0
    hits = 0
    for i, w in enumerate(low):
        value = weights.get(w, 0.0)
        if value == 0.0:
            continue
        hits += 1
        sign = 1.0 if value > 0 else -1.0
        before = low[max(0, i - R.WINDOW):i][::-1]
        value += sign * (R.CAPITALS if capitals and shouting[i] else 0.0)
        value += sign * sum(boosters.get(p, 0.0) * d for p, d in zip(before, R.DAMPING))
        if any(p in negators for p in before):
            value *= R.NEGATED
        if turn is not None:
            value *= R.BEFORE_CONTRAST if i < turn else R.AFTER_CONTRAST
        total += value
        positive += max(value, 0.0)
        negative += max(-value, 0.0)
    asked = text.count("?")
    push = min(text.count("!"), R.EXCLAMATIONS) * R.EXCLAMATION + (min(asked, R.QUESTIONS) * R.QUESTION if asked > 1 else 0.0)
    if total:
        total += push if total > 0 else -push
    return total, positive, negative, len(words) - hits, hits


def phrase_walk(text: str, entries: dict, longest: int, negators: set) -> tuple[float, float, int]:
    """(sum of polarities, sum of subjectivities, entries) of a left to right longest-match walk."""
    words = [w.lower() for w in _WORD.findall(text)]
    at = matched = 0
    polarity = subjectivity = 0.0
    intensity, ended = 1.0, -1  # of the entry that ended at the place before
    while at < len(words):
        for n in range(min(longest, len(words) - at), 0, -1):
            found = entries.get(" ".join(words[at:at + n]))
            if found:
                break
        else:
            at += 1
            continue
        own, subjective, strength = found
        if own:
            own *= intensity if ended == at else 1.0
            start = at - 1 if ended != at else -1
            if start >= 0 and words[start] in negators:
                own *= R.NEGATED_POLARITY
        polarity += max(-1.0, min(1.0, own))
        subjectivity += subjective
        matched += 1
        at += n
        intensity, ended = strength, at
    return polarity, subjectivity, matched


def _mapped(texts: DataFrame, id_col: str, text_col: str, score, columns: str) -> DataFrame:
    src = texts.select(id_col, text_col)

    def run(batches):
        for batch in batches:
            rows = [score(t or "") for t in batch.column(1).to_pylist()]
            kinds = [pa.float64() if c.endswith("double") else pa.int32() for c in columns.split(", ")]
            cells = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cells], names=[id_col, *(c.split()[0] for c in columns.split(", "))])

    return src.mapInArrow(run, f"{id_col} {src.schema[id_col].dataType.simpleString()}, {columns}")


def rule_scores(texts: DataFrame, weights: DataFrame, modifiers: DataFrame, id_col: str = "review_id", text_col: str = "review_text") -> DataFrame:
    """id, compound in -1 to 1, shares of positive, negative and neutral words, hits."""
    spark = texts.sparkSession
    by_kind: dict = {"booster": {}, "negator": {}, "contrast": {}}
    for r in _held(modifiers):
        by_kind[r["kind"]][r["word"]] = r["value"]
    shared = spark.sparkContext.broadcast(({r["word"]: r["weight"] for r in _held(weights)}, by_kind))
    found = _mapped(texts, id_col, text_col, lambda t: word_scores(t, *shared.value), "s double, pos double, neg double, plain int, hits int")
    s, whole = F.col("s"), F.col("pos") + F.col("neg") + F.col("plain")

    def share(part):
        return pg_round(F.when(whole > 0, F.col(part) / whole).otherwise(F.lit(0.0)), 3)

    return found.select(id_col, pg_round(s / F.sqrt(s * s + F.lit(ALPHA)), 4).alias("compound"), share("pos").alias("positive"),
                        share("neg").alias("negative"), share("plain").alias("neutral"), "hits")


def phrase_scores(texts: DataFrame, phrases: DataFrame, modifiers: DataFrame, id_col: str = "review_id", text_col: str = "review_text") -> DataFrame:
    """id, mean polarity and subjectivity of the entries met, entries."""
    entries = {r["phrase"]: (r["polarity"], r["subjectivity"], r["intensity"]) for r in _held(phrases)}
    longest = max((len(p.split(" ")) for p in entries), default=1)
    negators = {r["word"] for r in _held(modifiers.where("kind = 'negator'"))}
    shared = texts.sparkSession.sparkContext.broadcast((entries, longest, negators))
    found = _mapped(texts, id_col, text_col, lambda t: phrase_walk(t, *shared.value), "p double, u double, entries int")

    def mean(part):
        return pg_round(F.when(F.col("entries") > 0, F.col(part) / F.col("entries")).otherwise(F.lit(0.0)), 4)

    return found.select(id_col, mean("p").alias("polarity"), mean("u").alias("subjectivity"), "entries")
