"""Counts of words and word pairs of prepared texts (words joined by one space), exact, in one map over
Arrow batches each: a task adds up its own texts, so a row per term and task is shuffled, not one per
occurrence.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

# ---------------------------------------------------------------------------
# Texts taken from a batch at once, terms a task holds before it hands them on.
TEXTS_AT_ONCE = 512
HELD = 500_000
# ---------------------------------------------------------------------------

COUNTS = "{group} string, term string, tf long, df long"


def text_slices(batch: pa.RecordBatch, rows: int = TEXTS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def pairs(words: list[str], among: frozenset | set | None = None) -> list[str]:
    """Neighbouring words joined by a space; ``among``: only pairs of its words."""
    if among is None:
        return [f"{a} {b}" for a, b in zip(words, words[1:])]
    known = [w in among for w in words]
    return [f"{words[i]} {words[i + 1]}" for i in range(len(words) - 1) if known[i] and known[i + 1]]


def _counted(docs: DataFrame, group: str, text: str, terms_of) -> DataFrame:
    def run(batches):
        tf: dict = {}
        df: dict = {}

        def out():
            for g, counts in tf.items():
                names = list(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g] * len(names), pa.string()), pa.array(names, pa.string()),
                     pa.array(list(counts.values()), pa.int64()), pa.array([df[g][t] for t in names], pa.int64())],
                    names=[group, "term", "tf", "df"])
            tf.clear()
            df.clear()

        for batch in batches:
            for part in text_slices(batch):
                for g, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    terms = terms_of(g, t.split(" "))
                    if g not in tf:
                        tf[g], df[g] = Counter(), Counter()
                    tf[g].update(terms)
                    df[g].update(set(terms))
                if sum(map(len, tf.values())) > HELD:
                    yield from out()
        yield from out()

    shown = docs.where(F.col(text) != "").select(group, text)
    return (shown.mapInArrow(run, COUNTS.format(group=group)).groupBy(group, "term")
                 .agg(F.sum("tf").alias("tf"), F.sum("df").alias("df")))


def _slice_counts(part: pa.RecordBatch, names: list[str]) -> pa.RecordBatch:
    """(group, term, tf, df) of the words of a slice (group, text), added up as numbers."""
    lists = pc.split_pattern(part.column(1), " ")
    text_of, words = pc.list_parent_indices(lists).to_numpy(), pc.list_flatten(lists).dictionary_encode()
    groups = part.column(0).dictionary_encode(null_encoding="encode")
    n, group_of, codes = len(words.dictionary), groups.indices.to_numpy().astype(np.int64), words.indices.to_numpy()
    most = len(groups.dictionary) * n
    tf = np.bincount(group_of[text_of] * n + codes, minlength=most)
    once = np.sort(text_of.astype(np.int64) * n + codes)
    once = once[np.append(True, once[1:] != once[:-1])]
    df = np.bincount(group_of[once // n] * n + once % n, minlength=most)
    at = np.flatnonzero(tf)
    return pa.RecordBatch.from_arrays([groups.dictionary.take(pa.array(at // n)), words.dictionary.take(pa.array(at % n)),
                                       pa.array(tf[at]), pa.array(df[at])], names=names)


def word_counts(docs: DataFrame, group: str, text: str) -> DataFrame:
    """(group, term, tf, df) of the single words: occurrences and texts with the word."""
    names = [group, "term", "tf", "df"]

    def run(batches):
        held: list[pa.RecordBatch] = []

        def added():
            sums = pa.Table.from_batches(held).group_by(names[:2], use_threads=False).aggregate([("tf", "sum"), ("df", "sum")])
            return sums.select([*names[:2], "tf_sum", "df_sum"]).rename_columns(names).combine_chunks().to_batches()

        for batch in batches:
            for part in text_slices(batch):
                held.append(_slice_counts(part, names))
                if sum(x.num_rows for x in held) > 2 * HELD:
                    held = added()
                    if sum(x.num_rows for x in held) > HELD:
                        yield from held
                        held = []
        if held:
            yield from added()

    shown = docs.where(F.col(text) != "").select(group, text)
    return (shown.mapInArrow(run, COUNTS.format(group=group)).groupBy(group, "term")
                 .agg(F.sum("tf").alias("tf"), F.sum("df").alias("df")))


def pair_counts(docs: DataFrame, group: str, text: str, among: dict[str, frozenset] | None = None) -> DataFrame:
    """(group, term, tf, df) of neighbouring words; ``among``: per group, the words both must be of."""
    if among is None:
        return _counted(docs, group, text, lambda g, words: pairs(words))
    held = docs.sparkSession.sparkContext.broadcast(among)
    return _counted(docs, group, text, lambda g, words: pairs(words, held.value.get(g, frozenset())))


def known_terms(docs: DataFrame, key: str, group: str, text: str, terms: dict[str, list[str]], out: str) -> DataFrame:
    """(key, group, out): per text its words, then its word pairs, that are in its group's list, repeats
    included; one row per text, whose array may be empty."""
    held = docs.sparkSession.sparkContext.broadcast({
        g: (frozenset(t for t in ts if " " not in t), frozenset(t for t in ts if " " in t),
            frozenset(w for t in ts if " " in t for w in t.split(" "))) for g, ts in terms.items()})
    src = docs.select(key, group, F.coalesce(F.col(text), F.lit("")).alias(text))
    none = (frozenset(),) * 3

    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                found = []
                for g, t in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    single, double, inside = held.value.get(g, none)
                    words = t.split(" ")
                    found.append([w for w in words if w in single] + [p for p in pairs(words, inside) if p in double])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.list_(pa.string()))],
                                                 names=[key, group, out])

    kind = src.schema[key].dataType.simpleString()
    return src.mapInArrow(run, f"{key} {kind}, {group} string, {out} array<string>")
