"""Log-bilinear language model trained with noise-contrastive estimation.

The vector of a context is the sum of its two words' vectors, each scaled per dimension by its
position's weights; a word's logit is its product with the word's output vector plus a bias. Every
broadcast training word (below) seen ``LEAST`` times has its own vectors, so has the text's end; one
place stands for the words left, and there a word has its add-one share of their training tokens.
A word's probability is its frequency class's times its own in the class, both from the context's
vector: the classes have output vectors too. Training tells each token, at both levels, from
``NOISE`` draws of the unigram distribution. Scores are fully normalised, by matrix products over
all classes and over all words of the word's class.

Scale: every training document is counted and trained on. Tasks train on their own documents from
the same start; each hands on the rows of its tables that it trained, and blocks of rows are averaged
in a tree, each row by how often tasks trained it. Word counts are summed before the shuffle. Words
of at least one in ``HOT_SHARE`` tokens, so at most ``HOT_SHARE`` words, are broadcast with their
counts; only rarer words of each document, counted first, meet the count table in a join, which
therefore has no hot key.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avisflow.llm.common import crc_mod, slices, table, worker_cache

TOP, DIM, CONTEXT = 1022, 32, 2
OTHER, END, SIZE = TOP, TOP + 1, TOP + 2
#: Training tokens of a word with vectors at least; most frequent words that are classes of their own.
LEAST, FRONT = 2, 128
#: Distinct contexts of a token, about; places of a class, from and to.
CONTEXT_SHARE, WIDTHS = 0.66, (16, 4096)
NOISE, BATCH, RATE = 48, 4096, 0.03
#: Equal (word, context) cases of a slice are trained as one row of up to this weight.
WEIGHT = 8.0
HOT_SHARE = 1_000_000
SEED = 5
#: Rows of a parameter table that are averaged together.
ROWS = 4096
#: Tasks whose rows of a block meet in one task.
FAN = 16
#: Contexts whose products are held at once.
BLOCK = 512


def _words(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words of a column of texts, in order, as places among their distinct ones; those, as bytes; how
    many words each text has. Null counts as empty."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(column, "")))
    found = parts.flatten().dictionary_encode()
    at, sizes = found.indices.to_numpy().astype(np.int64), pc.list_value_length(parts).to_numpy().astype(np.int64)
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    words = found.dictionary.cast(kind)
    nothing = pc.index(words, pa.scalar(b"", kind)).as_py()
    if nothing >= 0:  # white space at a text's end leaves an empty word
        empty = at == nothing
        sizes -= np.bincount(np.repeat(np.arange(len(sizes)), sizes)[empty], minlength=len(sizes))
        at = at[~empty]
    return at, words, sizes


def _listed(words: pa.Array) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist()


def held_out(id_col: str):
    """Rows the model never learns from: crc32 of the id's text modulo 7 is 2."""
    return F.coalesce(crc_mod(id_col, 7) == 2, F.lit(False))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word binary, c): occurrences of each word in the column ``text``, ends of texts left out."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):  # a row for each distinct word of 8 MB
                at, words, _ = _words(part.column(0))
                c = np.bincount(at, minlength=len(words))
                held = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays([words.take(pa.array(held)).cast(pa.binary()), pa.array(c[held])], names=["word", "c"])

    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _contexts(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of many texts (ends included), and the one and two tokens before each; the end stands
    for what is before a text."""
    flat = np.concatenate([x for t in ids for x in (t, [END])]).astype(np.int64)
    before = np.concatenate([[END], flat[:-1]])
    first = np.concatenate([[True], flat[:-1] == END])
    two = np.concatenate([[END], before[:-1]])
    two[first] = END
    return flat, before, two


class Classes:
    """Frequency classes of the places: the ``FRONT`` first, the other words and the end are classes of
    one; the rest are runs of places, wide where words are rare. A run of width w costs w for each
    of its tokens and one more class for every context, so w grows with the root of one over the
    share of its first word."""

    def __init__(self, unigram: np.ndarray):
        n = len(unigram)
        share = unigram / unigram.sum()
        starts = [FRONT]
        while starts[-1] < n:
            at = starts[-1] + (starts[-1] in (OTHER, END))  # they stand among the places but are of no run
            width = np.sqrt(CONTEXT_SHARE / max(share[min(at, n - 1)], 1e-12))
            starts.append(starts[-1] + int(np.clip(width, *WIDTHS)))
        self.starts = np.array([*starts[:-1], n])
        self.kind = FRONT + 1 + np.searchsorted(self.starts, np.arange(n), "right")
        self.kind[:FRONT] = np.arange(FRONT)
        self.kind[OTHER], self.kind[END] = FRONT, FRONT + 1
        self.size = FRONT + 1 + len(self.starts)

    def members(self, k: int) -> slice:
        """The places of class ``k``, other words and the end among them or not."""
        return slice(int(self.starts[k - FRONT - 2]), int(self.starts[k - FRONT - 1]))


class Parameters:
    """The model's arrays, kept as one flat vector; ``n`` places."""

    def __init__(self, flat: np.ndarray, n: int, kinds: int):
        self.tables = {}
        at = 0
        for name, shape in self.shapes(n, kinds):
            size = int(np.prod(shape))
            self.tables[name] = flat[at:at + size].reshape(shape)
            setattr(self, name, self.tables[name])
            at += size

    @staticmethod
    def shapes(n: int, kinds: int) -> list:
        return [("context", (n, DIM)), ("weights", (CONTEXT, DIM)), ("output", (n, DIM)), ("bias", (n,)),
                ("class_output", (kinds, DIM)), ("class_bias", (kinds,))]

    @classmethod
    def start(cls, unigram: np.ndarray, seed: int = SEED) -> np.ndarray:
        rng = np.random.default_rng(seed)
        n = len(unigram)
        split = Classes(unigram)
        classes = np.maximum(np.bincount(split.kind, unigram, split.size), 1e-12)
        # within a class words start from their unigram shares
        parts = [rng.normal(0, 0.1, n * DIM), np.full(CONTEXT * DIM, 0.7), np.zeros(n * DIM), np.log(unigram),
                 rng.normal(0, 0.1, len(classes) * DIM), np.log(classes)]
        return np.concatenate(parts).astype(np.float32)

    def vectors(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        out, last = self.context.take(one, 0), self.context.take(two, 0)
        out *= self.weights[0]
        last *= self.weights[1]
        out += last
        return out


class _Groups:
    """Distinct values ``at`` of an index, the most frequent first; sums of the rows that share one."""

    def __init__(self, index: np.ndarray):
        m = len(index)
        key = np.sort(index * m + np.arange(m))  # sorts faster than the index's order is found
        held = key // m
        self.order = key - held * m
        first = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]]))
        count = np.diff(np.append(first, m))
        self.lead = np.argsort(-count)
        self.first, self.starts, self.count = first, first[self.lead], count[self.lead]
        self.at = held[self.starts]
        #: How many groups have more than one row, than two, ...
        self.live = np.searchsorted(-self.count, -np.arange(1, self.count[0] + 1)).tolist()

    def sums(self, rows: np.ndarray) -> np.ndarray:
        if rows.ndim == 1:
            return np.add.reduceat(rows.take(self.order), self.first).take(self.lead)
        out = rows.take(self.order.take(self.starts), 0)
        for done, live in enumerate(self.live, 1):  # the next row of all groups that have one; they stand first
            if live <= 16:
                break
            out[:live] += rows.take(self.order.take(self.starts[:live] + done), 0)
        for i in range(self.live[done - 1]):
            out[i] += rows.take(self.order[self.starts[i] + done:self.starts[i] + self.count[i]], 0).sum(0)
        return out


def _put(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Sets rows of a table; a row of many cells is moved as one."""
    if table.ndim > 1:
        cell = np.dtype((np.void, rows.shape[1] * rows.itemsize))
        table, rows = table.view(cell)[:, 0], rows.view(cell)[:, 0]
    table[at] = rows


class _Level:
    """One choice of the model: output table, bias, noise distribution."""

    def __init__(self, output: str, bias: str, share: np.ndarray):
        self.output, self.bias = output, bias
        share = share / share.sum()
        self.noise_log = np.log(NOISE * np.maximum(share, 1e-30)).astype(np.float32)
        self.cumulative = np.cumsum(share)
        self.last = int(np.flatnonzero(share)[-1])

    def draw(self, rng) -> np.ndarray:
        return np.searchsorted(self.cumulative, rng.random(NOISE) * self.cumulative[-1], "right").clip(0, self.last)


class Trainer:
    """Noise-contrastive estimation with AdaGrad steps; noise draws are shared by a batch."""

    def __init__(self, flat: np.ndarray, unigram: np.ndarray, seed: int = SEED):
        self.n = n = len(unigram)
        self.flat = flat.astype(np.float32).copy()
        split = Classes(unigram)
        self.p = Parameters(self.flat, n, split.size)
        self.square = Parameters(np.full(len(self.flat), 1e-8, np.float32), n, split.size)
        self.seen = {name: np.zeros(len(t), np.float32) for name, t in self.p.tables.items()}
        self.rng = np.random.default_rng(seed)
        self.kind = split.kind
        self.top = _Level("class_output", "class_bias", np.bincount(self.kind, unigram, split.size))
        self.inner = _Level("output", "bias", np.where(self.kind >= FRONT + 2, unigram, 0.0))

    def fit(self, word: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        """Every token of a slice, in random order; equal cases together, by weight."""
        n = self.n
        cases, counts = np.unique((word * n + one) * n + two, return_counts=True)
        rows = np.ceil(counts / WEIGHT).astype(np.int64)
        case = np.repeat(cases, rows)
        weight = np.repeat(counts / rows, rows).astype(np.float32)
        order = self.rng.permutation(len(case))
        for at in range(0, len(order), BATCH):
            rows = np.sort(order[at:at + BATCH])  # cases of a word stand together
            k, w = case[rows], weight[rows]
            word = k // (n * n)
            before = k - word * (n * n)
            one = before // n
            self.step(word, one, before - one * n, w)

    def step(self, word: np.ndarray, one: np.ndarray, two: np.ndarray, weight: np.ndarray) -> None:
        p = self.p
        order = np.argsort(self.kind[word] < FRONT + 2, kind="stable")  # words inside classes stand first
        word, one, two, weight = word[order], one[order], two[order], weight[order]
        kind = self.kind[word]
        tail = np.count_nonzero(kind >= FRONT + 2)
        m, total = len(word), weight.sum()
        c1, c2 = p.context.take(one, 0), p.context.take(two, 0)
        rows = np.empty((2 * m, DIM), np.float32)
        np.multiply(c1, p.weights[0], out=rows[:m])
        np.multiply(c2, p.weights[1], out=rows[m:])
        h = rows[:m] + rows[m:]
        back = self._contrast(self.top, h, kind, weight, total)
        if tail:
            back[:tail] += self._contrast(self.inner, h[:tail], word[:tail], weight[:tail], total)
        np.multiply(back, p.weights[0], out=rows[:m])
        np.multiply(back, p.weights[1], out=rows[m:])
        c1 *= back
        c2 *= back
        ones = np.ones(m, np.float32)
        groups = _Groups(np.concatenate([one, two]))
        self._add("context", groups.at, groups.sums(rows), total)
        self.seen["context"][groups.at] += groups.sums(np.concatenate([weight, weight]))
        self._add("weights", np.arange(CONTEXT), np.stack([ones @ c1, ones @ c2]), total)
        self.seen["weights"] += total

    def _contrast(self, level: _Level, h, target, weight, total) -> np.ndarray:
        """One level's step: its output rows move, the gradient of the contexts' vectors is returned."""
        output, bias = self.p.tables[level.output], self.p.tables[level.bias]
        noise = level.draw(self.rng)
        m = len(h)
        hit, miss = output.take(target, 0), output.take(noise, 0)
        up = np.einsum("ij,ij->i", h, hit)
        up += bias[target] - level.noise_log[target]
        np.exp(up, out=up)
        up += 1
        np.divide(weight, up, out=up)
        down = -miss @ h.T  # a row for each draw
        down += (level.noise_log[noise] - bias[noise])[:, None]
        np.exp(down, out=down)
        down += 1
        np.divide(-weight, down, out=down)
        back = down.T @ miss
        hit *= up[:, None]
        back += hit
        groups = _Groups(np.concatenate([target, noise]))
        rows = np.empty((m + NOISE, DIM), np.float32)
        np.multiply(h, up[:, None], out=rows[:m])
        np.matmul(down, h, out=rows[m:])
        self._add(level.output, groups.at, groups.sums(rows), total)
        self._add(level.bias, groups.at, groups.sums(np.concatenate([up, down @ np.ones(m, np.float32)])), total)
        trained = groups.sums(np.concatenate([weight, np.ones(NOISE, np.float32)]))
        self.seen[level.output][groups.at] += trained
        self.seen[level.bias][groups.at] += trained
        return back

    def _add(self, name: str, at: np.ndarray, grad: np.ndarray, total) -> None:
        grad /= total
        table, square = self.p.tables[name], self.square.tables[name]
        held = square.take(at, 0)
        held += grad * grad
        _put(square, at, held)
        np.sqrt(held, out=held)
        np.divide(grad, held, out=held)
        held *= RATE
        held += table.take(at, 0)
        _put(table, at, held)


class Scorer:
    """Normalised log probabilities."""

    def __init__(self, flat: np.ndarray, split: Classes):
        self.split, self.kind, self.n = split, split.kind, len(split.kind)
        self.p = Parameters(flat, self.n, split.size)

    def log_probs(self, word: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        key = one * self.n + two
        order = np.argsort(key)  # equal contexts stand together
        key, word = key[order], word[order]
        kind = self.kind[word]
        p = self._choice(key, kind, self.p.class_output, self.p.class_bias)
        tail = np.flatnonzero(kind >= FRONT + 2)
        tail = tail[np.argsort(kind[tail], kind="stable")]  # and inside a class still do
        kinds, starts = np.unique(kind[tail], return_index=True)
        for k, rows in zip(kinds.tolist(), np.split(tail, starts[1:])):
            held = self.split.members(k)
            bias = self.p.bias[held]
            for place in (OTHER, END):  # they stand among a class's places but are not of it
                if held.start <= place < held.stop:
                    bias = np.where(np.arange(held.start, held.stop) == place, np.float32(-1e30), bias)
            p[rows] += self._choice(key[rows], word[rows] - held.start, self.p.output[held], bias)
        out = np.empty(len(p))
        out[order] = p
        return out

    def _choice(self, key: np.ndarray, target: np.ndarray, output: np.ndarray, bias: np.ndarray) -> np.ndarray:
        """Log probabilities of targets among the rows of an output table; a context's products are
        computed once for its tokens, which stand together, in blocks that stay in the cache."""
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        ends = np.append(first, len(key))
        table, out = np.ascontiguousarray(output.T), bias[target].astype(np.float64)
        with np.errstate(over="ignore", invalid="ignore"):
            odds = np.exp(bias)
            for at in range(0, len(first), BLOCK):
                held = ends[at:at + BLOCK + 1]
                rows = slice(held[0], held[-1])
                of = key[held[:-1]]
                one = of // self.n
                h = self.p.vectors(one, of - one * self.n)
                z = h @ table
                place = np.repeat(np.arange(len(of)), np.diff(held))
                out[rows] += z.ravel().take(place * len(bias) + target[rows])
                sums = np.exp(z, out=z) @ odds
                odd = ~((sums > 1e-30) & (sums < 1e30))  # beyond single precision: from the largest product on
                norm = np.log(np.where(odd, 1, sums))
                if odd.any():
                    z = h[odd].astype(np.float64) @ table + bias
                    most = z.max(1)
                    norm[odd] = most + np.log(np.exp(z - most[:, None]).sum(1))
                out[rows] -= norm.take(place)
        return out


class Lexicon:
    """Hot words: their counts and their place in the model; rare words are -1."""

    def __init__(self, words: list[bytes], counts: list[int]):
        self.index = {w: i for i, w in enumerate(words)}
        self.counts = np.array([*counts, 0], np.int64)
        self.model = np.full(len(words) + 1, OTHER, np.int64)
        own = np.arange(np.count_nonzero(self.counts >= LEAST))
        self.model[:len(own)] = np.where(own < TOP, own, own + SIZE - TOP)
        self.n = max(SIZE, len(own) + SIZE - TOP)  # places
        self.own = len(own)

    def look_up(self, words: list[bytes]) -> np.ndarray:
        get = self.index.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))


def _train(texts: DataFrame, lexicon, unigram: np.ndarray) -> np.ndarray:
    n = len(unigram)
    shared = texts.sparkSession.sparkContext.broadcast(unigram)
    kinds_of = Classes(unigram).size
    kinds = [(name, shape[0], int(np.prod(shape[1:]))) for name, shape in Parameters.shapes(n, kinds_of)]
    columns = "part int, name int, block int, at binary, weight binary, rows binary"

    def packed(part, name, block, at, weight, rows):
        cells = [*(pa.array([x], pa.int32()) for x in (part, name, block)),
                 *(pa.array([x.tobytes()], pa.binary()) for x in (at.astype(np.int32), weight.astype(np.float32), rows.astype(np.float32)))]
        return pa.RecordBatch.from_arrays(cells, names=["part", "name", "block", "at", "weight", "rows"])

    def run(batches):
        trainer = None
        for batch in batches:
            for part in slices(batch, 0, 4 << 20):
                if trainer is None:
                    trainer = Trainer(Parameters.start(shared.value), shared.value)
                lex = lexicon.value
                at, words, sizes = _words(part.column(0))
                places = lex.model[lex.look_up(_listed(words))][at]
                word, one, two = _contexts(np.split(places, np.cumsum(sizes)[:-1]))
                trainer.fit(word, one, two)
        if trainer is not None:
            part = TaskContext.get().partitionId() // FAN
            for i, (name, size, width) in enumerate(kinds):
                seen, rows = trainer.seen[name], trainer.p.tables[name].reshape(size, width)
                for block in range(0, size, ROWS):
                    at = np.flatnonzero(seen[block:block + ROWS])
                    if len(at):
                        yield packed(part, i, block, at, seen[block + at], rows[block + at])

    def average(batches):
        held: dict = {}
        for batch in batches:
            for part, i, block, at, weight, rows in zip(*(c.to_pylist() for c in batch.columns)):
                size, width = kinds[i][1:]
                key = part, i, block
                if key not in held:
                    held[key] = np.zeros(min(ROWS, size - block)), np.zeros((min(ROWS, size - block), width))
                at, weight = np.frombuffer(at, np.int32), np.frombuffer(weight, np.float32).astype(np.float64)
                held[key][0][at] += weight
                held[key][1][at] += weight[:, None] * np.frombuffer(rows, np.float32).reshape(-1, width)
        for key, (weight, rows) in held.items():
            at = np.flatnonzero(weight)
            yield packed(*key, at, weight[at], rows[at] / weight[at, None])

    flat = Parameters.start(unigram)
    tables = Parameters(flat, n, kinds_of).tables
    trained = texts.mapInArrow(run, columns)
    while True:  # a tree: FAN tasks' rows of a block are averaged together, then FAN of those averages
        trained = table(trained.repartition("name", "block", "part").mapInArrow(average, columns), "lm-rows")
        if not trained.agg(F.max("part")).first()[0]:
            break
        trained = trained.withColumn("part", F.floor(F.col("part") / FAN).cast("int"))
    for r in trained.toLocalIterator():  # one row per block of the tables: at most the broadcast words' rows
        name, size, width = kinds[r["name"]]
        tables[name].reshape(size, width)[r["block"] + np.frombuffer(r["at"], np.int32)] = np.frombuffer(r["rows"], np.float32).reshape(-1, width)
    return flat


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per input row.

    Tokens: the text's words (between ASCII white space, A-Z as a-z) and one end; null and empty
    texts have the end only. base_score: add-one unigram log10 probability from the training rows;
    score: the model's. Without training rows both fall back on uniform shares. A null id is not
    held out; rows that repeat a doc_id count and score each. Other columns are not read.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    training = src.where(~F.col("held_out")).select("text")
    counts = table(word_counts(training), "word-counts")
    ends = training.count()
    whole = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_train, n_kinds = (whole["n"] or 0) + ends, whole["v"] + (ends > 0)
    hot = counts.where(F.col("c") * HOT_SHARE >= n_train).collect()  # HOT_SHARE words at most
    hot.sort(key=lambda r: (-r["c"], bytes(r["word"])))
    lex = Lexicon([bytes(r["word"]) for r in hot], [r["c"] for r in hot])
    top = lex.counts[:lex.own]
    others = n_train - ends - int(top.sum())
    other_kinds = n_kinds - (ends > 0) - len(top)
    mass = np.full(lex.n, 1e-3)  # places without a word keep a trace of mass
    mass[lex.model[:len(top)]] = top
    mass[OTHER], mass[END] = others + 1, ends + 1
    unigram = mass / mass.sum()
    lexicon = spark.sparkContext.broadcast(lex)
    flat = _train(training, lexicon, unigram) if ends else Parameters.start(unigram)
    model = spark.sparkContext.broadcast((flat, Classes(unigram)))
    name = uuid.uuid4().hex  # of this model, in the workers' cache
    share = np.log10(others + other_kinds + 1.0)  # denominator inside the class of other words

    def run(batches):
        cache = worker_cache("lm-scorer")
        if cache.get("of") != name:
            cache.update(of=name, scorer=Scorer(*model.value))
        scorer, lex = cache["scorer"], lexicon.value
        logs = np.log10(lex.counts + 1.0)
        for batch in batches:
            for part in slices(batch, 2):
                code, words, sizes = _words(part.column(2))
                found = lex.look_up(_listed(words))[code]
                cuts = np.cumsum(sizes)[:-1]
                word, one, two = _contexts(np.split(lex.model[found], cuts))
                p = scorer.log_probs(word, one, two) / np.log(10)
                # distinct rare words of each text, with their counts
                cold = np.flatnonzero(found < 0)
                text = np.repeat(np.arange(len(sizes)), sizes)[cold]
                pairs, times = np.unique(text * len(words) + code[cold], return_counts=True)
                lists = np.searchsorted(pairs, np.arange(len(sizes) + 1) * len(words)).astype(np.int32)
                rare = words.take(pa.array(pairs % max(1, len(words)))).cast(pa.binary())
                starts = np.cumsum(sizes + 1) - sizes - 1
                is_word = np.ones(len(word), bool)
                is_word[starts + sizes] = False
                flat_at = np.full(len(word), -1)
                flat_at[is_word] = found
                known = is_word & (flat_at >= 0)
                # Hot words' shares: of all tokens, and of the class of other words.
                base = np.where(known, logs[flat_at], 0.0)
                inner = np.where(is_word & (word == OTHER), base - share, 0.0)
                cols = [np.add.reduceat(x, starts) for x in (p + inner, base, known.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sizes + 1), *(pa.array(c) for c in cols),
                     pa.ListArray.from_arrays(lists, rare), pa.ListArray.from_arrays(lists, pa.array(times, pa.int64()))],
                    names=["doc_id", "held_out", "n_tokens", "model", "base", "hot_known", "rare", "rare_n"])

    kind = src.schema["doc_id"].dataType.simpleString()
    scored = table(src.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, model double, base double, "
                                       "hot_known long, rare array<binary>, rare_n array<long>")
                   .withColumn("rid", F.monotonically_increasing_id()), "lm-scored")
    cold = counts.where(F.col("c") * HOT_SHARE < n_train).select(F.col("word").alias("w"), "c")
    pairs = scored.select("rid", F.explode(F.arrays_zip("rare", "rare_n")).alias("r")).select(
        "rid", F.col("r.rare").alias("word"), F.col("r.rare_n").alias("k"))
    # no word here is hot, so a hash join of counts is even; the pairs need no sort
    met = (pairs.join(cold.hint("shuffle_hash"), pairs.word == cold.w).groupBy("rid")
           .agg(F.sum("k").alias("rare_known"), F.sum(F.col("k") * F.log10(F.col("c") + 1.0)).alias("rare_base"))
           .select(F.col("rid").alias("m_rid"), "rare_known", "rare_base"))
    met = table(met, "lm-rare")
    n = F.col("n_tokens")
    zero = F.lit(0.0)
    end_known = F.lit(1 if ends else 0)
    return (scored.drop("rare").join(met, scored.rid == met.m_rid, "left")
            .select("doc_id", "held_out", "n_tokens",
                    (F.col("hot_known") + F.coalesce("rare_known", F.lit(0)) + end_known).cast("long").alias("n_known"),
                    F.lit(int(n_train)).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("rare_base", zero) + F.lit(float(np.log10(ends + 1.0)))
                     - n * F.lit(float(np.log10(n_train + n_kinds + 1.0)))).alias("base_score"),
                    (F.col("model") + F.coalesce("rare_base", zero)).alias("score")))
