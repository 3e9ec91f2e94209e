"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network.

Random indexing gives each word a fixed sparse vector of +1 and -1 (its index vector, from a hash)
and adds up the index vectors around its occurrences into its word vector; words share a table of
``ROWS`` hashed rows. A word also counts as its shape (character classes, runs collapsed), so words
never seen in training still carry signal. A document is pooled into the means of its word and
shape vectors and their spread; a two-layer numpy network and a temperature, fitted on examples
kept from training, turn that into a probability.

Learning uses at most about ``FIT_ROWS`` labelled rows (a documented bound; chosen by a hash, so
reruns agree). Tables of fixed size and the pooled vectors of those rows are all that reaches the
driver; scoring is one pass over the texts with the fixed-size model broadcast.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from avisflow.llm.common import crc_mod, labelled_texts, slices, table, text_bytes, worker_cache

DIM, ROWS, NONZERO, WINDOW = 48, 1 << 14, 4, 2
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 2e-3, 1e-4
FIT_ROWS, THRESHOLD, SEED = 20000, 0.7, 11
_CACHE_WORDS = 400_000
_SHAPE = bytes(range(48)) + b"0" * 10 + bytes(range(58, 65)) + b"A" * 26 + bytes(range(91, 97)) + b"a" * 26 \
    + bytes(range(123, 128)) + b"a" * 128
_RUN = re.compile(rb"(.)\1+", re.S)


def _ids(words: list[bytes], known: dict) -> np.ndarray:
    """(n, 2) hashed rows of each word and of its shape."""
    out = list(map(known.get, words))
    for i, pair in enumerate(out):
        if pair is None:
            w = words[i]
            pair = known.get(w)
            if pair is None:
                if len(known) >= _CACHE_WORDS:
                    known.clear()
                shape = b"\0" + _RUN.sub(rb"\1", w.translate(_SHAPE))[:16]
                pair = known[w] = (zlib.crc32(w) % ROWS) << 16 | zlib.crc32(shape) % ROWS
            out[i] = pair
    packed = np.array(out, np.int64)
    return np.stack([packed >> 16, packed & 0xFFFF], axis=1)


def index_vectors(seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of every row's index vector."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, DIM, (ROWS, NONZERO)), rng.choice(np.array([-1.0, 1.0], np.float32), (ROWS, NONZERO))


def _add_contexts(sums, ids, places, signs) -> None:
    """Context sums of many texts at once; tokens of different texts are never neighbours."""
    gap = np.full((WINDOW, 2), -1)
    padded = np.concatenate([x for pair in ((t, gap) for t in ids) for x in pair])
    for kind in (0, 1):
        row = padded[:, kind]
        for d in range(1, WINDOW + 1):
            for a, b in ((row[d:], row[:-d]), (row[:-d], row[d:])):
                ok = (a >= 0) & (b >= 0)
                if ok.any():
                    flat = a[ok, None] * DIM + places[b[ok]]
                    sums += np.bincount(flat.ravel(), weights=signs[b[ok]].ravel(), minlength=ROWS * DIM)


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Unit rows: the context sums plus a little of the row's own index vector."""
    places, signs = index_vectors()
    vec = sums.reshape(ROWS, DIM).astype(np.float32)
    np.add.at(vec, (np.arange(ROWS)[:, None], places), 0.5 * signs)
    return vec / np.maximum(np.linalg.norm(vec, axis=1, keepdims=True), 1e-9)


def pooled(texts: list[bytes], vectors: np.ndarray, known: dict) -> np.ndarray:
    """One row per text: means of word and shape vectors, spread of word vectors; zeros if no word."""
    out = np.zeros((len(texts), 3 * DIM), np.float32)
    for i, text in enumerate(texts):
        words = text.split()
        total = np.zeros((3, DIM))
        for at in range(0, len(words), 1 << 16):
            ids = _ids(words[at:at + (1 << 16)], known)
            w = vectors[ids[:, 0]]
            total[0] += w.sum(0, dtype=np.float64)
            total[1] += vectors[ids[:, 1]].sum(0, dtype=np.float64)
            total[2] += np.einsum("ij,ij->j", w, w)
        if words:
            total /= len(words)
            out[i] = np.concatenate([total[0], total[1], np.sqrt(np.maximum(total[2] - total[0] ** 2, 0))])
    return out


def train_network(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> dict:
    """Two layers (tanh, logistic) by Adam; temperature on a fifth of the rows kept from training."""
    rng = np.random.default_rng(seed)
    prior = (y.sum() + 1.0) / (len(y) + 2.0)
    mean, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(3 * DIM), np.ones(3 * DIM))
    net = {"mean": mean.astype(np.float32), "scale": scale.astype(np.float32), "t": 1.0, "fitted": False,
           "w1": (rng.standard_normal((3 * DIM, HIDDEN)) / np.sqrt(3 * DIM)).astype(np.float32),
           "b1": np.zeros(HIDDEN, np.float32), "w2": np.zeros(HIDDEN, np.float32),
           "b2": np.float32(np.log(prior / (1 - prior)))}
    if len(y) < 20 or y.min() == y.max():
        return net  # too little to learn from: every text scores the prior
    net["fitted"] = True
    z = ((x - net["mean"]) / net["scale"]).astype(np.float32)
    order = rng.permutation(len(y))
    held, fit = order[:len(y) // 5], order[len(y) // 5:]
    moment = {k: (np.zeros_like(net[k]), np.zeros_like(net[k])) for k in ("w1", "b1", "w2", "b2")}
    step = 0
    for _ in range(EPOCHS):
        rng.shuffle(fit)
        for at in range(0, len(fit), BATCH):
            rows = fit[at:at + BATCH]
            h = np.tanh(z[rows] @ net["w1"] + net["b1"])
            err = (1 / (1 + np.exp(-(h @ net["w2"] + net["b2"]))) - y[rows]) / len(rows)
            back = err[:, None] * net["w2"] * (1 - h * h)
            grads = {"w1": z[rows].T @ back + DECAY * net["w1"], "b1": back.sum(0),
                     "w2": h.T @ err + DECAY * net["w2"], "b2": err.sum()}
            step += 1
            for k, g in grads.items():
                m, v = moment[k]
                m = 0.9 * m + 0.1 * g
                v = 0.999 * v + 0.001 * g * g
                moment[k] = m, v
                net[k] = (net[k] - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    logit = logits(net, x[held])
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
    loss = [np.logaddexp(0, np.where(y[held] == 1, -logit, logit) / t).mean() for t in grid]
    net["t"] = float(grid[int(np.argmin(loss))])
    return net


def logits(net: dict, x: np.ndarray) -> np.ndarray:
    z = ((x - net["mean"]) / net["scale"]).astype(np.float32)
    return np.tanh(z @ net["w1"] + net["b1"]).astype(np.float64) @ net["w2"] + net["b2"]


def probability(net: dict, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logits(net, x) / net["t"], -500, 500)))


def held_out(id_col: str):
    """Rows whose label is never learned from: crc32 of the id's text modulo 4 is 2."""
    return F.coalesce(crc_mod(id_col, 4) == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", fit_rows: int = FIT_ROWS) -> dict:
    """Learn word vectors, network and temperature from at most about ``fit_rows`` labelled ids. An id
    with labels of both kinds is not learned from; of rows that repeat an id the largest text is."""
    spark = docs.sparkSession
    texts = table(labelled_texts(docs, labels, id_col, text_col, label_col, fit_rows, held_out, SEED), "labelled")

    def contexts(batches):
        sums, ids_of, (places, signs) = np.zeros(ROWS * DIM), {}, index_vectors()
        for batch in batches:
            for part in slices(batch, 1, 2 << 20):
                ids = [_ids(w, ids_of) for w in (t.split() for t in text_bytes(part.column(1))) if w]
                if ids:
                    _add_contexts(sums, ids, places, signs)
        yield pa.RecordBatch.from_arrays([pa.array([sums.astype(np.float32).tobytes()], pa.binary())], names=["sums"])

    parts = texts.coalesce(8).mapInArrow(contexts, "sums binary").collect()  # eight tables of fixed size
    sums = np.zeros(ROWS * DIM, np.float32)
    for r in parts:
        sums += np.frombuffer(r["sums"], np.float32)
    vectors = word_vectors(sums)
    shared = spark.sparkContext.broadcast(vectors)

    def pool(batches):
        for batch in batches:
            for part in slices(batch, 1):
                x = pooled(text_bytes(part.column(1)), shared.value, worker_cache("quality-words"))
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int32()), pa.array([r.tobytes() for r in x], pa.binary())],
                                                 names=["y", "x"])

    rows = texts.mapInArrow(pool, "y int, x binary").collect()  # at most about fit_rows pooled vectors
    rows.sort(key=lambda r: (r["x"], r["y"]))  # the same order whatever the partitions
    x = np.frombuffer(b"".join(r["x"] for r in rows), np.float32).reshape(-1, 3 * DIM)
    y = np.array([r["y"] for r in rows], np.float64)
    return {"vectors": shared, "net": train_network(x, y)}


def score(docs: DataFrame, model: dict, text_col: str = "text", threshold: float = THRESHOLD,
          score_name: str = "score", predicted_name: str = "predicted") -> DataFrame:
    """``docs`` with a probability of good quality and its 0/1 decision appended.

    Null and empty texts are scored as texts without words; no row is dropped and the other columns
    pass through untouched. The two new names must not occur in ``docs`` (they are parameters). An
    empty table gives no rows; without labels of both kinds every text scores the labels' prior.
    """
    clash = {score_name, predicted_name} & set(docs.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    shared, net, at = model["vectors"], model["net"], docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in slices(batch, at):
                p = probability(net, pooled(text_bytes(part.column(at)), shared.value, worker_cache("quality-words")))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                    names=[*part.schema.names, score_name, predicted_name])

    schema = T.StructType([*docs.schema.fields, T.StructField(score_name, T.DoubleType()), T.StructField(predicted_name, T.IntegerType())])
    return docs.mapInArrow(run, schema)
