"""Toxicity: a factorization machine over hashed terms.

A text's terms are its words (A-Z as a-z, cut at ASCII punctuation, digits and white space) and
their beginnings of ``PREFIXES`` bytes, hashed into ``PLACES`` places, and its length. Of the places
the machine keeps those that tell the two classes of the labelled texts apart (by the standardised
difference of document frequencies), at most ``TERMS``. With x the saturated counts of the kept
places, a text's logit is b + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j: pairs weigh apart from
their parts, so a word that is harmless alone counts beside another, and more in a short text.

Learning uses at most about ``FIT_ROWS`` labelled ids (a documented bound, chosen by a hash). Tables
of fixed size and the kept places of those rows are all that reaches the driver; scoring is one
pass over the texts with the fixed-size model broadcast.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from avisflow.llm.common import crc_mod, labelled_texts, slices, table, text_bytes, worker_cache

PLACES, PREFIXES, TERMS = 1 << 18, (3, 4, 5, 6, 7), 4096
#: Documents with a place, and standard deviations between the classes, at least; count that saturates.
LEAST, APART, MOST = 5, 5.0, 3
RANK, EPOCHS, BATCH, RATE, DECAY = 8, 20, 64, 0.05, 1e-2
FIT_ROWS, THRESHOLD, SEED = 20000, 0.7, 17
_CACHE_WORDS = 400_000
_LETTERS = bytes(i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i > 127 else 32 for i in range(256))
_CUT = 1 << 20


def word_counts(text: bytes) -> Counter:
    """Words of a whole text with their counts, cut into runs so that memory does not follow its length."""
    text, held, at = text.translate(_LETTERS), Counter(), 0
    while at < len(text):
        end = text.find(b" ", at + _CUT)
        end = len(text) if end < 0 else end
        held.update(text[at:end].split())
        at = end
    return held


def places_of(word: bytes) -> list[int]:
    """Hashed places of a word and of its beginnings."""
    return [zlib.crc32(word) % PLACES, *(zlib.crc32(b"%d\0" % n + word[:n]) % PLACES for n in PREFIXES if len(word) > n)]


def length_term(n_words: int) -> float:
    return (np.log1p(n_words) - 5.0) / 1.5


def saturated(counts: np.ndarray) -> np.ndarray:
    return np.minimum(counts, MOST) * (2.0 / MOST)


def kept_places(seen: np.ndarray, seen_toxic: np.ndarray, n: int, n_toxic: int) -> np.ndarray:
    """Places that tell the classes apart, strongest ``TERMS`` of them, in ascending order."""
    share = seen / max(n, 1)
    spread = np.sqrt(n_toxic * (1 - n_toxic / max(n, 1)) * share * (1 - share))
    apart = np.abs(seen_toxic - n_toxic * share) / np.maximum(spread, 1e-9)
    at = np.flatnonzero((seen >= LEAST) & (spread > 0) & (apart >= APART))
    return np.sort(at[np.argsort(-apart[at], kind="stable")[:TERMS]])


def logits(model: dict, row: np.ndarray, term: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """The machine's value for ``n`` texts from their (row, term, x) entries, rows ascending."""
    v = model["v"][term] * x[:, None]
    one, square, linear = np.zeros((n, RANK)), np.zeros((n, RANK)), np.bincount(row, model["w"][term] * x, n)
    if len(row):
        at = np.flatnonzero(np.diff(row, prepend=-1))
        one[row[at]], square[row[at]] = np.add.reduceat(v, at), np.add.reduceat(v * v, at)
    return model["b"] + linear + 0.5 * (one * one - square).sum(1)


def train(entries: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, terms: int, seed: int = SEED) -> dict:
    """Weights and vectors of ``terms`` terms by AdaGrad over (terms, values) of each text."""
    rng = np.random.default_rng(seed)
    toxic = float(y.sum())
    model = {"b": float(np.log((toxic + 1) / (len(y) - toxic + 1))), "w": np.zeros(terms), "v": rng.normal(0, 0.02, (terms, RANK))}
    if not 0 < toxic < len(y):
        return model | {"fitted": False}  # nothing to tell apart: every text scores the prior
    square_w, square_v, square_b = np.full(terms, 1e-6), np.full((terms, RANK), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            rows = order[at:at + BATCH]
            term = np.concatenate([entries[i][0] for i in rows])
            x = np.concatenate([entries[i][1] for i in rows])
            row = np.repeat(np.arange(len(rows)), [len(entries[i][0]) for i in rows])
            err = (1 / (1 + np.exp(-np.clip(logits(model, row, term, x, len(rows)), -30, 30))) - y[rows]) / len(rows)
            v = model["v"][term] * x[:, None]
            starts = np.flatnonzero(np.diff(row, prepend=-1))
            one = np.add.reduceat(v, starts)[row]  # every text has the length term
            back = err[row] * x
            used, which = np.unique(term, return_inverse=True)
            by_term = np.argsort(which, kind="stable")
            first = np.searchsorted(which[by_term], np.arange(len(used)))
            g_w = np.add.reduceat(back[by_term], first) + DECAY * model["w"][used] / len(rows)
            g_v = np.add.reduceat((back[:, None] * (one - v))[by_term], first) + DECAY * model["v"][used] / len(rows)
            square_w[used] += g_w ** 2
            square_v[used] += g_v ** 2
            square_b += err.sum() ** 2
            model["w"][used] -= RATE * g_w / np.sqrt(square_w[used])
            model["v"][used] -= RATE * g_v / np.sqrt(square_v[used])
            model["b"] -= RATE * err.sum() / np.sqrt(square_b)
    return model | {"fitted": True}


def held_out(id_col: str):
    """Rows whose label is never learned from: crc32 of the id's text modulo 3 is 1."""
    return F.coalesce(crc_mod(id_col, 3) == 1, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, fit_rows: int) -> DataFrame:
    """The rows to learn from: one per labelled id that is not held out."""
    return labelled_texts(docs, labels, id_col, text_col, label_col, fit_rows, held_out, SEED)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        fit_rows: int = FIT_ROWS) -> dict:
    """Kept places and the machine, learned from at most about ``fit_rows`` labelled ids. An id with
    labels of both kinds is not learned from; of rows that repeat an id the largest text is."""
    spark = docs.sparkSession

    def counted(batches):
        for batch in batches:
            for part in slices(batch, 1):
                for y, text in zip(part.column(0).to_pylist(), text_bytes(part.column(1))):
                    words = word_counts(text)
                    sums = Counter()
                    for w, c in words.items():
                        for p in places_of(w):
                            sums[p] += c
                    at = np.array(sorted(sums), np.int32)
                    counts = np.array([sums[p] for p in at.tolist()], np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([y], pa.int32()), pa.array([words.total()], pa.int64()), pa.array([at.tobytes()], pa.binary()),
                         pa.array([np.minimum(counts, MOST).astype(np.uint8).tobytes()], pa.binary())], names=["y", "n_words", "places", "counts"])

    texts = table(labelled(docs, labels, id_col, text_col, label_col, fit_rows)
                  .mapInArrow(counted, "y int, n_words long, places binary, counts binary"), "toxic-labelled")

    def frequencies(batches):
        seen = np.zeros((2, PLACES), np.int64)
        n = np.zeros(2, np.int64)
        for batch in batches:
            for y, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[y, np.frombuffer(places, np.int32)] += 1
                n[y] += 1
        yield pa.RecordBatch.from_arrays([pa.array([seen.astype(np.int32).tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())], names=["seen", "n"])

    seen, n = np.zeros((2, PLACES)), np.zeros(2)
    for r in texts.select("y", "places").coalesce(8).mapInArrow(frequencies, "seen binary, n binary").collect():  # eight tables of fixed size
        seen += np.frombuffer(r["seen"], np.int32).reshape(2, PLACES)
        n += np.frombuffer(r["n"], np.int64)
    kept = kept_places(seen.sum(0), seen[1], int(n.sum()), int(n[1]))

    def reduced(batches):
        for batch in batches:
            ys, sizes, places, counts = (c.to_pylist() for c in batch.columns)
            out = []
            for size, p, c in zip(sizes, places, counts):
                p, c = np.frombuffer(p, np.int32), np.frombuffer(c, np.uint8)
                at = np.searchsorted(kept, p).clip(0, max(len(kept) - 1, 0))
                hit = kept[at] == p if len(kept) else np.zeros(len(p), bool)
                out.append((np.append(at[hit], len(kept)).astype(np.int32).tobytes(), np.append(saturated(c[hit]), length_term(size)).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(ys, pa.int32()), *(pa.array(x, pa.binary()) for x in zip(*out))] if out else
                                             [pa.array([], t) for t in (pa.int32(), pa.binary(), pa.binary())], names=["y", "terms", "x"])

    # at most about fit_rows rows of kept places, in the same order whatever the partitions
    rows = sorted((bytes(r["terms"]), bytes(r["x"]), r["y"]) for r in texts.mapInArrow(reduced, "y int, terms binary, x binary").collect())
    entries = [(np.frombuffer(t, np.int32).astype(np.int64), np.frombuffer(x)) for t, x, _ in rows]
    model = train(entries, np.array([y for *_, y in rows], float), len(kept) + 1)
    return {"kept": kept, "model": model, "shared": spark.sparkContext.broadcast((kept, model)), "name": uuid.uuid4().hex}


def text_entries(texts: list[bytes], kept: np.ndarray, known: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, x) of the texts; ``known`` keeps the kept places of words."""
    index = known.setdefault(None, {int(p): i for i, p in enumerate(kept)})
    rows, terms, xs = [], [], []
    for i, text in enumerate(texts):
        words, sums = word_counts(text), Counter()
        for w, c in words.items():
            at = known.get(w)
            if at is None:
                if len(known) > _CACHE_WORDS:
                    known.clear()
                    known[None] = index
                at = known[w] = tuple(index[p] for p in places_of(w) if p in index)
            for t in at:
                sums[t] += c
        own = sorted(sums)
        rows.append(np.full(len(own) + 1, i))
        terms.append(np.array([*own, len(kept)], np.int64))
        xs.append(np.append(saturated(np.array([sums[t] for t in own], float)), length_term(words.total())))
    return np.concatenate(rows), np.concatenate(terms), np.concatenate(xs)


def score(docs: DataFrame, fitted: dict, text_col: str = "text", threshold: float = THRESHOLD, score_name: str = "score",
          predicted_name: str = "predicted") -> DataFrame:
    """``docs`` with the probability of toxicity and its 0/1 decision appended.

    Null and empty texts are scored as texts without words; no row is dropped, rows that repeat are
    scored alike, and the other columns pass through untouched. The two new names must not occur in
    ``docs`` (they are parameters). An empty table gives no rows; without labels of both kinds every
    text scores the labels' prior (0.5 without labels).
    """
    clash = {score_name, predicted_name} & set(docs.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    shared, name, at = fitted["shared"], fitted["name"], docs.columns.index(text_col)

    def run(batches):
        kept, model = shared.value
        cache = worker_cache("toxicity-words")
        if cache.get("of") != name:
            cache.clear()
            cache.update(of=name, words={})
        for batch in batches:
            for part in slices(batch, at):
                if model["fitted"]:
                    value = logits(model, *text_entries(text_bytes(part.column(at)), kept, cache["words"]), part.num_rows)
                else:
                    value = np.full(part.num_rows, model["b"])
                p = 1 / (1 + np.exp(-np.clip(value, -500, 500)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                                                 names=[*part.schema.names, score_name, predicted_name])

    schema = T.StructType([*docs.schema.fields, T.StructField(score_name, T.DoubleType()), T.StructField(predicted_name, T.IntegerType())])
    return docs.mapInArrow(run, schema)
