"""Phrase collocations level by level, counted exactly in sorted integers.

A phrase of k words is looked for only where both phrases of k - 1 words inside it are frequent in
all texts. Words become integers once (``coded``); from then on a level reads rows of integers: at
each place the id of the frequent phrase of k - 1 words that starts there, or -1. Two neighbouring
ids are the key of a phrase of k words, 64 bits that no other phrase has. A shard sorts its keys,
counts equal ones and hands on one packed row per bucket of keys, some six bytes a key; a bucket's
rows are added up in one place, and what reaches the support is a frequent phrase, its place in the
order of keys its id. Counts are the texts' own, so no second pass checks them, and scores need
nothing else: both parts of a cut of a frequent phrase are frequent themselves.

Scale: what is written grows with the words and not with the number of shards: per level at most a
packed key per word and a rewritten row of integers, fewer where phrases grow rare. Memory of a task
follows ``SHARD_WORDS``. Broadcast are the frequent words (a hundredth of all words at most) and, in
parts of ``HELD_PHRASES`` keys, a level's frequent phrases; each further part reads the places again.
Spellings are put together in joins by id.
"""

from __future__ import annotations

import functools
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from avisflow.llm.common import slices, table, text_bytes
from avisflow.session import scratch_path

SUPPORT, LONGEST, COVER, TOP = 100, 5, 100, 2000
#: Words counted together, phrases broadcast at once, different words a task counts before it hands them on.
SHARD_WORDS, HELD_PHRASES, COUNTED_WORDS = 8_000_000, 8_000_000, 500_000
#: Words that become integers together, places of a row.
CODED_WORDS, ROW_PLACES = 2_000_000, 1 << 16
UNKNOWN = "und"
_MARK = b"\xff"  # stands for the end of a piece; no byte of UTF-8
_PIECES = bytes(0xFF if chr(i) in ".,;:!?\n\x0b\x0c\r" else i for i in range(256))
_CUT = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)  # odd, so keys can be had back
_UNMIX = np.uint64(pow(int(_MIX), -1, 1 << 64))


def words(text: bytes):
    """Lists of the words of a text in order, with marks where a piece ends; a megabyte or so each."""
    text = text.lower().translate(_PIECES)  # bytes: only A-Z change
    at = 0
    while at < len(text):
        end = at + _CUT
        if end < len(text):  # cut behind a word
            stops = [p for p in (text.find(c, end) for c in (b" ", b"\t", _MARK)) if p >= 0]
            end = min(stops, default=len(text))
        yield text[at:end].replace(_MARK, b" \xff ").split()
        at = end


def _column_texts(batches):
    for batch in batches:
        for part in slices(batch, 1):
            yield from zip(part.column(0).to_pylist(), text_bytes(part.column(1)))


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, f): occurrences of every word, and of all words of a language as the word ``''``."""
    def out(held):
        for lang, counts in held.items():
            counts.pop(_MARK, None)
            names = [w.decode() for w in counts] + [""]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(names), pa.string()), pa.array(names, pa.string()),
                                              pa.array([*counts.values(), sum(counts.values())], pa.int64())], names=["lang", "word", "f"])

    def run(batches):
        held: dict[str, Counter] = {}
        distinct = 0
        for lang, text in _column_texts(batches):
            counts = held.setdefault(lang, Counter())
            for found in words(text):
                distinct -= len(counts)
                counts.update(found)
                distinct += len(counts)
                if distinct > COUNTED_WORDS:
                    yield from out(held)
                    counts = Counter()
                    held, distinct = {lang: counts}, 0
        yield from out(held)

    return texts.mapInArrow(run, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


class Shard:
    """Words of one language as integers; -1 ends a piece."""

    def __init__(self):
        self.index: dict[bytes, int] = {_MARK: -1}
        self.parts: list[np.ndarray] = []
        self.size = self.closed = 0  # words and marks held; those up to the last mark

    def add(self, found: list[bytes]) -> None:
        index = self.index
        for w in set(found).difference(index):
            index[w] = len(index) - 1
        part = np.fromiter(map(index.__getitem__, found), np.int32, len(found))
        marks = np.flatnonzero(part < 0)
        if len(marks):
            self.closed = self.size + int(marks[-1]) + 1
        self.size += len(part)
        self.parts.append(part)

    def take(self) -> np.ndarray:
        """What is held up to the last mark; an open piece stays."""
        flat = np.concatenate(self.parts)
        self.parts = [flat[self.closed:]]
        out, self.size, self.closed = flat[:self.closed], self.size - self.closed, 0
        return out

    def names(self) -> list[bytes]:
        return list(self.index)[1:]


def _shards(batches, shard_words: int):
    """(lang, words as integers, their spelling) for every shard of a task. A shard ends with a
    piece; only a piece that is longer than a shard itself makes it larger."""
    held: dict[str, Shard] = {}
    for lang, text in _column_texts(batches):
        shard = held.setdefault(lang, Shard())
        for found in words(text):
            shard.add(found)
            if sum(s.closed for s in held.values()) >= shard_words:
                for name in list(held):
                    flat = held[name].take()
                    if len(flat):
                        yield name, flat, held[name].names()
                    if not held[name].size and held[name] is not shard:
                        del held[name]
                if not shard.size:
                    shard = held[lang] = Shard()
        shard.add([_MARK])
    for name, s in held.items():
        yield name, s.take(), s.names()


def _rows_of(node: np.ndarray, at: np.ndarray, *also: np.ndarray):
    """Runs of about ``ROW_PLACES`` places, each up to and with a place of -1; the last ends with one."""
    cuts = np.unique(at[np.searchsorted(at, np.arange(ROW_PLACES, len(node), ROW_PLACES)).clip(0, len(at) - 1)] + 1) if len(at) else at
    for a, b in zip([0, *cuts], [*cuts, len(node)]):
        if a < b:
            yield [x[a:b].tobytes() for x in (node, *also)]


def _packed(node: np.ndarray):
    """Rows of places of which some matter, without all but the first of neighbouring -1."""
    node = np.append(node, -1).astype(np.int32)
    known = node >= 0
    node = node[known | np.append(False, known[:-1])]
    yield from _rows_of(node, np.flatnonzero(node < 0))


def _batch(rows, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()) for c in zip(*rows)], names=names)


def coded(texts: DataFrame, words_of: dict[str, tuple[int, pa.Array]]) -> DataFrame:
    """(node): the texts as ids of frequent words, -1 for others and where a piece ends. ``words_of``:
    per language the first id and the words in the order of ids."""
    shared = texts.sparkSession.sparkContext.broadcast(words_of)

    def run(batches):
        for lang, flat, names in _shards(batches, CODED_WORDS):
            if lang in shared.value and len(flat):
                first, known = shared.value[lang]
                place = pc.index_in(pa.array(names, pa.binary()), value_set=known).fill_null(-1 - first).to_numpy().astype(np.int64) + first
                for row in _packed(np.append(place, -1)[flat]):
                    yield _batch([row], ["node"])

    return texts.mapInArrow(run, "node binary")


def _joined(batches, most: int):
    """Rows of integers put together to ``most`` places or so; as many arrays as columns."""
    held, size = [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            row = [np.frombuffer(c[i].as_buffer(), np.int32) if c[i].is_valid else None for c in batch.columns]
            held.append(row)
            size += len(row[0])
            if size >= most:
                yield [None if c[0] is None else np.concatenate(c) for c in zip(*held)]
                held, size = [], 0
    if held:
        yield [None if c[0] is None else np.concatenate(c) for c in zip(*held)]


def _keys(node: np.ndarray):
    """Places of two neighbouring ids, and their keys: a one-to-one mix that spreads them over 64 bits."""
    at = np.flatnonzero((node[:-1] >= 0) & (node[1:] >= 0))
    return at, (node[at].astype(np.uint64) << np.uint64(32) | node[at + 1].astype(np.uint64)) * _MIX


def _planes(values: np.ndarray) -> bytes:
    """Bytes of one rank side by side: where most are 0, they take next to no room compressed."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _unplaned(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def frequent_pairs(nodes: DataFrame, support: int, total: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(bucket, n, keys, counts): sorted keys of the pairs of neighbouring ids with at least ``support``
    occurrences, and their numbers; ``total``: words of all texts."""
    shards = max(1, -(-total // shard_words))
    bits = max(10, shards.bit_length() + 3)

    def counted(batches):
        for (node,) in _joined(batches, shard_words):
            _, keys = _keys(node)
            keys.sort()
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
            counts, keys = np.diff(np.append(first, len(keys))).astype(np.uint32), keys[first]
            ends = np.append(np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)), len(keys))
            rows, size, a = [], 0, 0
            for bucket, b in enumerate(ends.tolist()):
                if a < b:
                    rows.append((bucket, _planes(np.diff(keys[a:b], prepend=np.uint64(0))), _planes(counts[a:b])))
                    size, a = size + b - a, b
                    if size > ROW_PLACES:
                        yield _buckets(rows)
                        rows, size = [], 0
            if rows:
                yield _buckets(rows)

    def added(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for bucket, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(bucket, []).append((keys, counts))
        for bucket in sorted(held):
            rows = held.pop(bucket)
            keys = np.concatenate([np.cumsum(_unplaned(k, np.uint64)) for k, _ in rows])
            order = np.argsort(keys)
            keys = keys[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            f = np.add.reduceat(np.concatenate([_unplaned(c, np.uint32) for _, c in rows])[order].astype(np.int64), first)
            kept = f >= support
            if kept.any():
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([int(kept.sum())], pa.int64()), pa.array(
                    [keys[first][kept].tobytes()], pa.binary()), pa.array([f[kept].tobytes()], pa.binary())], names=["bucket", "n", "keys", "counts"])

    parts = max(8, -(-4 * total // SHARD_WORDS))
    rows = nodes.coalesce(shards).mapInArrow(counted, "bucket int, keys binary, counts binary")
    return rows.repartition(parts, "bucket").mapInArrow(added, "bucket int, n long, keys binary, counts binary")


def _buckets(rows) -> pa.RecordBatch:
    bucket, keys, counts = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())],
                                      names=["bucket", "keys", "counts"])


def _first_ids(frequent: DataFrame) -> tuple[dict[int, int], int]:
    """({bucket: id of its first phrase}, number of phrases); one row per bucket reaches the driver."""
    first, at = {}, 0
    for bucket, n in sorted(frequent.select("bucket", "n").collect()):
        first[bucket], at = at, at + n
    return first, at


def next_nodes(nodes: DataFrame, frequent: DataFrame, first: dict[int, int], total: int, held_phrases: int = HELD_PHRASES) -> DataFrame:
    """(node): at each place the id of the frequent phrase that starts there and is one word longer."""
    parts, buckets = [], list(first)
    for i, bucket in enumerate(buckets):
        end = first[buckets[i + 1]] if i + 1 < len(buckets) else total
        if not parts or end - parts[-1][2] > held_phrases:
            parts.append([bucket, bucket, first[bucket]])
        parts[-1][1] = bucket
    rows = nodes.withColumn("found", F.lit(None).cast("binary"))
    for low, high, at in parts:
        last = high == buckets[-1]
        got = sorted(frequent.where(F.col("bucket").between(low, high)).select("bucket", "keys").collect())
        shared = nodes.sparkSession.sparkContext.broadcast(np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in got]))
        del got

        def run(batches, shared=shared, at=at, last=last):
            known = shared.value
            for node, found in _joined(batches, CODED_WORDS):
                place, keys = _keys(node)
                order = np.argsort(keys)  # neighbours in order are neighbours in memory
                keys = keys[order]
                where = np.searchsorted(known, keys).clip(0, len(known) - 1)
                hit = known[where] == keys
                found = np.full(len(node), -1, np.int32) if found is None else found.copy()
                found[place[order[hit]]] = where[hit] + at
                for row in _packed(found) if last else _rows_of(node, np.flatnonzero(node < 0), found):
                    yield _batch([row], ["node", "found"][:len(row)])

        rows = places(rows.mapInArrow(run, "node binary" if last else "node binary, found binary"))
    return rows


def places(nodes: DataFrame) -> DataFrame:
    """``nodes`` written, in row groups that are small beside a task's memory, and read again."""
    path = scratch_path(nodes.sparkSession, "llm", "phrase-places")
    nodes.write.option("parquet.block.size", 16 << 20).parquet(path)
    return nodes.sparkSession.read.schema(nodes.schema).parquet(path)


def _numbered(frequent: DataFrame, first: dict[int, int]) -> DataFrame:
    """(id, a, b, f): a row per phrase, with the ids of the two phrases of one word less inside it."""
    shared = frequent.sparkSession.sparkContext.broadcast(first)

    def run(batches):
        for batch in batches:
            for bucket, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                keys, counts = np.frombuffer(keys, np.uint64) * _UNMIX, np.frombuffer(counts, np.int64)
                ids = np.arange(len(keys)) + shared.value[bucket]
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array((keys >> np.uint64(32)).astype(np.int64)), pa.array(
                    (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(counts)], names=["id", "a", "b", "f"])

    return frequent.select("bucket", "keys", "counts").mapInArrow(run, "id long, a long, b long, f long")


def _named(numbered: DataFrame, shorter: DataFrame) -> DataFrame:
    """(id, lang, phrase, f): the first of the two phrases inside and the last word of the second."""
    one = shorter.select(F.col("id").alias("a"), "lang", F.col("phrase").alias("head"))
    other = shorter.select(F.col("id").alias("b"), F.substring_index("phrase", " ", -1).alias("tail"))
    return numbered.join(one, "a").join(other, "b").select("id", "lang", F.concat_ws(" ", "head", "tail").alias("phrase"), "f")


def _named_words(spark, words_of: dict[str, tuple[int, pa.Array]], f: np.ndarray) -> DataFrame:
    """(id, lang, phrase, f) of the frequent words."""
    shared = spark.sparkContext.broadcast((words_of, f))

    def run(batches):
        words_of, f = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for lang, (first, known) in words_of.items():
                own = ids[(ids >= first) & (ids < first + len(known))]
                if len(own):
                    yield pa.RecordBatch.from_arrays([pa.array(own), pa.array([lang] * len(own), pa.string()),
                                                      known.take(pa.array(own - first)).cast(pa.string()), pa.array(f[own])], names=["id", "lang", "phrase", "f"])

    return spark.range(len(f)).mapInArrow(run, "id long, lang string, phrase string, f long")


def frequent_phrases(texts: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shard_words: int = SHARD_WORDS,
                     held_phrases: int = HELD_PHRASES) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, f), (lang, n)) of ``texts`` (lang, text): exact counts of the phrases of one
    to ``longest`` words with at least ``support`` occurrences."""
    spark = texts.sparkSession
    counted = table(word_counts(texts).where((F.col("f") >= support) | (F.col("word") == "")), "phrase-words")
    totals = counted.where("word = ''").select("lang", F.col("f").alias("n"))
    total = totals.agg(F.sum("n")).first()[0] or 0
    known = counted.where("word <> ''").toPandas().sort_values("lang", kind="stable", ignore_index=True)  # of each 100 words one at most
    words_of = {lang: (int(own.index[0]), pa.array([w.encode() for w in own["word"]], pa.binary())) for lang, own in known.groupby("lang")}
    named = [table(_named_words(spark, words_of, known["f"].to_numpy(np.int64)), "phrase-names")]
    del known
    nodes = places(coded(texts, words_of)) if words_of and longest > 1 else None
    for k in range(2, longest + 1 if words_of else 2):
        frequent = table(frequent_pairs(nodes, support, total, shard_words), "phrase-level")
        first, found = _first_ids(frequent)
        if not found:
            break
        named.append(table(_named(_numbered(frequent, first), named[-1]), "phrase-names"))
        if k < longest:
            nodes = next_nodes(nodes, frequent, first, found, held_phrases)
    return table(functools.reduce(DataFrame.unionByName, named).drop("id"), "phrases"), totals


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT, longest: int = LONGEST,
                 cover: int = COVER, top: int = TOP, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` collocations.

    Words stand between spaces and tabs inside pieces, pieces between ``[.,;:!?\\x0A-\\x0D]``, A-Z as
    a-z; a null language counts as ``und``, a null text as empty. Candidates have 2 to ``longest``
    words and a = f(phrase) >= ``support``. Of a candidate's cuts into l = f(first part) and
    r = f(rest) the one with the lowest floor(1000 a n / (l r)) counts, then the shortest first part.
    Candidates inside a longer one with 100 f(longer) >= ``cover`` a go. Ties in rank: a descending,
    phrase ascending in UTF-8 byte order. Rows that repeat count each; no rows give no rows. Other
    columns are not read.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text"))
    found, totals = frequent_phrases(texts, support, longest, **options)
    f = found.select(F.col("lang").alias("f_lang"), F.col("phrase").alias("f_phrase"), "f")
    parts = found.withColumn("w", F.split("phrase", " ")).where(F.size("w") > 1)

    def piece(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    # What lies inside a longer candidate lies inside one of just one word more with as many or more occurrences.
    inner = (parts.where(F.size("w") > 2).select("lang", F.col("f").alias("longer"), F.explode(F.array(
        piece(F.lit(1), F.size("w") - 1), piece(F.lit(2), F.size("w") - 1))).alias("inside"))
        .groupBy("lang", "inside").agg(F.max("longer").alias("longer")).select(F.col("lang").alias("i_lang"), "inside", "longer"))
    open_ = parts.join(inner, (F.col("lang") == F.col("i_lang")) & (F.col("phrase") == F.col("inside")), "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < F.lit(cover) * F.col("f"))).select("lang", "phrase", F.col("f").alias("a"), "w")
    cuts = open_.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", piece(F.lit(1), F.col("k")).alias("head"),
                       piece(F.col("k") + 1, F.size("w") - F.col("k")).alias("tail"))

    def count_of(rows, part, name):
        side = f.select(F.col("f_lang").alias(f"{name}_lang"), F.col("f_phrase").alias(f"{name}_phrase"), F.col("f").alias(name))
        return rows.join(side, (F.col("lang") == F.col(f"{name}_lang")) & (F.col(part) == F.col(f"{name}_phrase"))).drop(
            f"{name}_lang", f"{name}_phrase")

    sized = totals.select(F.col("lang").alias("n_lang"), "n")
    scored = count_of(count_of(cuts, "head", "l"), "tail", "r").join(sized, F.col("lang") == F.col("n_lang"))
    scored = scored.withColumn("score", F.expr(
        "cast(1000 * a as decimal(18,0)) * cast(n as decimal(19,0)) div (cast(l as decimal(18,0)) * cast(r as decimal(19,0)))"))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
