"""Online variational Bayes for LDA as Spark ML's ``LDA(optimizer="online", subsamplingRate=1.0)`` does
it, with the documents of a task inferred together in matrices instead of one by one.

Everything that decides the result is Spark ML's: 100 draws of the documents with replacement
(``DataFrame.sample`` takes them as ``RDD.sample`` does), the start of a document's topics by the seed
of the pass and its partition, updates until they change by less than 1e-3, learning rate and
document prior. A document drawn twice in a pass has the same topics twice and is inferred once, with
its number as weight. Results differ by rounding alone; tests hold them against Spark ML's.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

# ---------------------------------------------------------------------------
# Fixed values of Spark ML: learning offset and decay, shape of the random starts, change that ends
# the inference of a document, seed of a fitted model (hash of its class name).
TAU0, KAPPA, GAMMA_SHAPE, LEAST_CHANGE, MODEL_SEED = 1024.0, 0.51, 100.0, 1e-3, 1421925485
# Documents inferred together (their matrix stays in a core's cache) and fewest that are moved together,
# documents whose features are held, documents of a task of a pass.
TOGETHER, MOVED, FEATURED, DOCS_A_TASK = 1024, 128, 16_384, 20_000
# ---------------------------------------------------------------------------


class JavaRandom:
    """java.util.Random: the seeds of draws and starts."""

    def __init__(self, seed: int):
        self._state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def _next32(self) -> int:
        self._state = (self._state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        return (self._state >> 16) - ((self._state >> 47) << 32)

    def next_long(self) -> int:
        return _signed((self._next32() << 32) + self._next32())


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (x >> 63 << 64)


def gammas(seed: int, n: int, shape: float = GAMMA_SHAPE) -> np.ndarray:
    """``n`` draws of Gamma(shape, 1 / shape) as Breeze makes them from a Mersenne Twister (Marsaglia, Tsang)."""
    seed &= (1 << 64) - 1
    bits = np.random.RandomState([seed >> 32, seed & 0xFFFFFFFF])
    raw, spare, out = [], [], []

    def uniform():
        if not raw:
            raw.extend(bits.randint(0, 1 << 32, 64, np.uint32).tolist()[::-1])
        high, low = raw.pop(), raw.pop()
        return (high >> 6 << 26 | low >> 6) * 2.0 ** -52

    def gauss():
        if spare:
            return spare.pop()
        angle, r = 2 * math.pi * uniform(), math.sqrt(-2 * math.log(uniform()))
        spare.append(r * math.sin(angle))
        return r * math.cos(angle)

    b = shape - 1.0 / 3.0
    c = 1.0 / math.sqrt(9 * b)
    while len(out) < n:
        v = 0.0
        while v <= 0:
            x = gauss()
            v = 1.0 + c * x
        v, u = v ** 3, uniform()
        if u < 1.0 - 0.0331 * x ** 4 or math.log(u) < 0.5 * x * x + b * (1.0 - v + math.log(v)):
            out.append(b * v / shape)
    return np.array(out)


def _raised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """z and r with psi(x) = log(z) - r for x > 0: six steps up, then the asymptotic series."""
    y = x * (x + 5.0)  # x (x + 5), (x + 1) (x + 4), (x + 2) (x + 3) are y, y + 4, y + 6
    low = y + 4.0
    low *= y + 6.0
    r = 2.0 * y  # r = (2 x + 5) (1 / y + 1 / (y + 4) + 1 / (y + 6)), in one fraction
    r += 10.0
    r *= y
    r += low
    r *= 2.0 * x + 5.0
    low *= y
    r /= np.maximum(low, 1e-300, out=low)
    z = x + 6.0
    u = 1.0 / z
    w = u * u
    h = w * (-691 / 32760)
    for c in (1 / 132, -1 / 240, 1 / 252, -1 / 120, 1 / 12):
        h += c
        h *= w
    u *= 0.5
    r += u
    r += h
    return z, r


def digamma(x: np.ndarray) -> np.ndarray:
    z, r = _raised(x)
    return np.log(z) - r


def exp_digamma(x: np.ndarray) -> np.ndarray:
    z, r = _raised(x)
    return z * np.exp(-r)


def trigamma(x: np.ndarray) -> np.ndarray:
    out = sum(1.0 / ((x + j) * (x + j)) for j in range(20))
    z = 1.0 / (x + 20)
    w = z * z
    return out + z + w / 2 + z * w * (1 / 6 - w * (1 / 30 - w * (1 / 42 - w / 30)))


def expectation(alpha: np.ndarray) -> np.ndarray:
    """E[log p] under Dirichlet(alpha), column by column."""
    both = digamma(np.concatenate([alpha, alpha.sum(axis=0, keepdims=True)]))
    return both[:-1] - both[-1:]


def infer(docs: np.ndarray, gamma: np.ndarray, beta: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """Topic weights (topics, documents) of documents (documents, words) from their starts (topics,
    documents); beta: exp E[log] of (topics, words). The place of a document that ends is taken by
    the next one, so products stay large; a document is a column, which BLAS is quicker with. Within a
    document a common factor of the topics' weights cancels out, so exp psi(gamma) does without the sum's."""
    out, flat, mean = np.empty_like(gamma), np.ascontiguousarray(beta.T), np.full(len(alpha), 1.0 / len(alpha))
    alpha, first = alpha[:, None], exp_digamma(gamma)
    at = np.arange(min(len(docs), TOGETHER))
    own, theta, now, going = np.ascontiguousarray(docs[at].T), first[:, at], gamma[:, at], np.ones(len(at), bool)
    waiting, share = len(at), np.empty_like(own)  # fresh memory for every product would cost more than the product
    while going.any():
        np.matmul(flat, theta, out=share)
        share += 1e-100
        np.divide(own, share, out=share)
        last, now = now, theta * (beta @ share) + alpha
        theta = exp_digamma(now)
        ended = np.flatnonzero(going & ~(mean @ np.abs(now - last) > LEAST_CHANGE))
        out[:, at[ended]] = now[:, ended]
        if waiting < len(docs):
            new = np.arange(waiting, min(len(docs), waiting + len(ended)))
            ended, place, waiting = ended[len(new):], ended[:len(new)], waiting + len(new)
            at[place], own[:, place], theta[:, place], now[:, place] = new, docs[new].T, first[:, new], gamma[:, new]
        going[ended] = False
        if MOVED <= np.count_nonzero(going) <= 0.8 * len(at):  # small products are slower than large ones
            at, own, theta, now, going = at[going], own[:, going], theta[:, going], now[:, going], going[going]
            share = np.empty_like(own)
    return out


@dataclass
class Model:
    topics: np.ndarray  # (topics, words), not normalized
    alpha: np.ndarray

    def described(self, most: int) -> list[tuple[list[int], list[float]]]:
        """Per topic its leading words and their shares."""
        shares = self.topics / self.topics.sum(axis=1, keepdims=True)
        order = np.argsort(-shares, axis=1, kind="stable")[:, :most]
        return [(o.tolist(), s[o].tolist()) for o, s in zip(order, shares)]


def features(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Counts times idf, each row of length 1 (no words: 0)."""
    x = counts * idf
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(size > 0, size, 1.0)


def count_rows(docs: DataFrame, key: str, group: str, terms_col: str, terms: dict[str, list[str]]) -> DataFrame:
    """(key, group, counts): per document the numbers of the terms of its group's list, in one, two or four bytes each."""
    names = {g: {t: i for i, t in enumerate(ts)} for g, ts in terms.items()}

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, FEATURED):
                some, packed = batch.slice(a, FEATURED), []
                for g, d in zip(some.column(1).to_pylist(), some.column(2).to_pylist()):
                    own = names.get(g, {})
                    counts = np.bincount([own[t] for t in d or () if t in own] or np.zeros(0, np.int64), minlength=len(own))
                    most = counts.max(initial=0)
                    packed.append(counts.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32).tobytes())
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(packed, pa.binary())], names=[key, group, "counts"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, group, terms_col).mapInArrow(run, f"{key} {kind}, {group} string, counts binary")


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` with their partition and their order in it (``at``: Spark's own number of both), which draws
    and starts go by: to be written before use."""
    return rows.withColumn("at", F.monotonically_increasing_id())


def _matrix(column: pa.Array, words: int) -> np.ndarray:
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    if (np.diff(ends) == words).all():
        return np.frombuffer(column.buffers()[2], np.uint8, len(column) * words, int(ends[0])).reshape(-1, words)
    return np.array([np.frombuffer(c, {1: np.uint8, 2: np.uint16, 4: np.uint32}[len(c) // words]) for c in column.to_pylist()], np.uint32).reshape(-1, words)


def fit(rows: DataFrame, idf: list[float], k: int, max_iter: int, seed: int) -> Model:
    """The model of ``placed`` rows; per pass each task sends the driver one row of topics times words."""
    spark, words = rows.sparkSession, len(idf)
    slim = rows.select("at", "counts").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        corpus = slim.count()
        tasks = max(spark.sparkContext.defaultParallelism, -(-corpus // DOCS_A_TASK))
        idf = np.array(idf)
        random = JavaRandom(seed)
        topics = gammas(random.next_long(), k * words).reshape(k, words)
        alpha, eta, passed = np.full(k, 1.0 / k), 1.0 / k, 0
        for _ in range(max_iter):
            drawn = slim.sample(True, 1.0, random.next_long())
            ahead = JavaRandom(0)
            ahead._state = random._state
            beta, start = np.exp(expectation(topics.T)).T.copy(), ahead.next_long()
            found = _pass(drawn.coalesce(tasks), idf, beta, alpha, start).collect()
            if not sum(r["drawn"] for r in found):
                continue
            random, passed = ahead, passed + 1
            filled = sum(r["filled"] for r in found)
            if not filled:
                continue
            stat = sum(np.frombuffer(r["stat"]) for r in found).reshape(k, words) * beta
            weight = (TAU0 + passed) ** -KAPPA
            topics = (1 - weight) * topics + weight * (stat + eta)
            alpha = _prior(alpha, sum(np.frombuffer(r["logs"]) for r in found) / filled, filled, weight)
    finally:
        slim.unpersist()
    return Model(topics, alpha)


def _prior(alpha: np.ndarray, logs: np.ndarray, n: int, weight: float) -> np.ndarray:
    grad = n * (logs - expectation(alpha))
    c, q = n * trigamma(alpha.sum()), -n * trigamma(alpha)
    b = (grad / q).sum() / (1.0 / c + (1.0 / q).sum())
    step = weight * (-(grad - b) / q)
    return alpha + step if (alpha + step > 0).all() else alpha


def _pass(drawn: DataFrame, idf: np.ndarray, beta: np.ndarray, alpha: np.ndarray, start: int) -> DataFrame:
    """(stat, logs, drawn, filled) of a task: topics times words, expected logs, documents, those with words."""
    k, words = beta.shape

    def some(batches):
        """Places and counts of the documents with words, put together to ``FEATURED`` or so, and the number of all."""
        held, size, n = [], 0, 0
        for batch in batches:
            if batch.num_rows:
                counts = _matrix(batch.column(1), words)
                filled = np.flatnonzero(counts.any(axis=1))
                held.append((batch.column(0).to_numpy()[filled], counts[filled]))
                size, n = size + len(filled), n + batch.num_rows
            if size >= FEATURED:
                yield [np.concatenate(c) for c in zip(*held)], n
                held, size, n = [], 0, 0
        yield [np.concatenate(c) for c in zip(*held)], n

    def run(batches):
        stat, logs, n_drawn, n_filled, starts = np.zeros((k, words)), np.zeros(k), 0, 0, {}
        for columns, n in some(batches):
            n_drawn += n
            if not columns or not len(columns[0]):
                continue
            at, counts = columns
            n_filled += len(at)
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            times = np.diff(np.append(first, len(at))).astype(float)
            counts, part = counts[first], at[first] >> 33
            for p in np.unique(part).tolist():
                if p not in starts:
                    starts[p] = gammas(start + p, k)
            docs = features(counts, idf)
            gamma = infer(docs, np.array([starts[p] for p in part.tolist()]).T.copy(), beta, alpha)
            logs_of = expectation(gamma)
            theta = np.exp(logs_of)
            stat += (theta * times) @ (docs / (theta.T @ beta + 1e-100))
            logs += logs_of @ times
        yield pa.RecordBatch.from_arrays([pa.array([stat.tobytes()], pa.binary()), pa.array([logs.tobytes()], pa.binary()),
                                          pa.array([n_drawn]), pa.array([n_filled])], names=["stat", "logs", "drawn", "filled"])

    return drawn.mapInArrow(run, "stat binary, logs binary, drawn long, filled long")


def assign(rows: DataFrame, key: str, idf: list[float], model: Model) -> DataFrame:
    """(key, topic, share): each document's leading topic (the first on ties) and its share; 0 and 0 without words."""
    idf, k = np.array(idf), len(model.alpha)
    beta, alpha = np.exp(expectation(model.topics.T)).T.copy(), model.alpha
    start = gammas(MODEL_SEED, k)

    def run(batches):
        for batch in batches:
            counts = _matrix(batch.column(1), len(idf)) if batch.num_rows else None
            for a in range(0, batch.num_rows, FEATURED):
                docs = features(counts[a:a + FEATURED], idf)
                gamma = infer(docs, np.tile(start[:, None], (1, len(docs))), beta, alpha)
                share = np.where(docs.any(axis=1), gamma / gamma.sum(axis=0), 0.0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, FEATURED), pa.array(share.argmax(axis=0).astype(np.int32)),
                                                  pa.array(share.max(axis=0))], names=[key, "topic", "share"])

    kind = rows.schema[key].dataType.simpleString()
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // DOCS_A_TASK))
    return rows.select(key, "counts").coalesce(tasks).mapInArrow(run, f"{key} {kind}, topic int, share double")
