"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The distinct words of many texts lie in flat arrays of symbols. Each round takes the smallest pair
rank of every word at once (a segmented minimum), merges the leftmost place of that rank in every
word, all at the same time, and compacts the arrays; words without a pair leave. Where no piece
built on the merged one ranks better than it, all places of the rank in a word are merged in the
same round, leftmost first and without overlap, which gives what one merge at a time gives.

Texts are cut before each run of word marks that follows another character: no piece of the
vocabulary holds a mark behind another character, so no merge crosses a cut (checked on loading).
The model file is read on the driver only; its vocabulary, of fixed size, is broadcast. Tasks keep
a bounded dictionary of encoded words. Encoding is a map over the texts, with no shuffle.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from avisflow.llm.common import slices, worker_cache

MARK = "▁"
NONE = np.int32(np.iinfo(np.int32).max)
_CACHE_WORDS, _CACHE_CHARS = 300_000, 16 << 20
#: Merge rounds after which a word goes on with a queue.
ROUNDS = 64
_SEGMENT = re.compile(f"{MARK}+[^{MARK}]*")


class Vocabulary:
    """Pieces, pair ranks and byte fallback of a BPE model; plain arrays, so it can be broadcast."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        self.bos, self.eos, self.unk = model.bos_id(), model.eos_id(), model.unk_id()
        byte_ids = [i for i in range(size) if model.is_byte(i)]
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i)} | set(byte_ids)
        if any(model.is_unused(i) for i in range(size)) or len(byte_ids) != 256:
            raise ValueError("this encoder needs byte fallback and no unused pieces")
        pieces = {model.id_to_piece(i): i for i in range(size) if i not in special}
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece holds a word mark behind another character")
        if model.encode("a  b", out_type=str)[0][:1] != MARK or model.decode(model.encode(" a  b ")) != " a  b ":
            raise ValueError("this encoder needs the dummy prefix and kept white space")
        scores = {i: model.get_score(i) for i in pieces.values()}
        # Symbols: ids of pieces, then characters that occur in pieces without being one.
        symbols, self.chars = dict(pieces), np.full(0x110000, -1, np.int32)
        for c in sorted({c for p in pieces for c in p} - set(pieces)):
            symbols[c] = size + len(symbols) - len(pieces)
        for s, i in symbols.items():
            if len(s) == 1:
                self.chars[ord(s)] = i
        self.other = size + len(symbols) - len(pieces)  # stands for any further character
        longer = [p for p in pieces if len(p) > 1]
        levels = sorted({scores[pieces[p]] for p in longer}, reverse=True)
        level_of = {x: r for r, x in enumerate(levels)}
        rank_of = {p: level_of[scores[pieces[p]]] for p in longer}
        keys, ranks, merged = [], [], []
        # A rank is safe if nothing built on its piece ranks as well or better, and no piece shares it.
        self.safe = np.bincount(list(rank_of.values()), minlength=len(levels)) == 1
        for p, r in rank_of.items():
            for cut in range(1, len(p)):
                a, b = p[:cut], p[cut:]
                if a in symbols and b in symbols:
                    keys.append(symbols[a] * (self.other + 1) + symbols[b])
                    ranks.append(r)
                    merged.append(pieces[p])
                    for part in (a, b):
                        if rank_of.get(part, -1) >= r:
                            self.safe[rank_of[part]] = False
        order = np.argsort(keys)
        # The last entry stands for pairs that merge into nothing.
        self.keys = np.array(keys, np.int64)[order]
        self.ranks, self.merged = np.append(np.array(ranks, np.int32)[order], NONE), np.append(np.array(merged, np.int32)[order], -1)
        self.is_piece = np.zeros(self.other + 1, bool)
        self.is_piece[list(pieces.values())] = True
        self.bytes = np.array(sorted(byte_ids, key=lambda i: int(model.id_to_piece(i)[1:-1], 16)), np.int32)
        self.surface = [b""] * size
        for p, i in pieces.items():
            self.surface[i] = p.replace(MARK, " ").encode()
        for value, i in enumerate(self.bytes.tolist()):
            self.surface[i] = bytes([value])
        self.surface[self.unk] = " ⁇ ".encode()
        self._lookup: dict[int, int] | None = None

    def lookup(self) -> dict[int, int]:
        """Entries by key, made when a word first needs them."""
        if self._lookup is None:
            self._lookup = {k: i for i, k in enumerate(self.keys.tolist())}
        return self._lookup

    def pairs(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray) -> np.ndarray:
        """Entry of each pair; the last one where there is none or the two are not joined."""
        key = left.astype(np.int64) * (self.other + 1) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(joined & (self.keys[at] == key), at, len(self.keys)).astype(np.int32)


def _firsts(word: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.nonzero(word[1:] != word[:-1])[0] + 1])


def _merge_queue(sym: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of one long word merged by a queue of its pairs, best and leftmost first, in n log n
    steps; with the places where they began."""
    n, lookup, ranks, merged = len(sym), vocab.lookup(), vocab.ranks.tolist(), vocab.merged.tolist()
    none, base = len(vocab.keys), vocab.other + 1
    s, after, before = sym.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
    pair = vocab.pairs(sym[:-1], sym[1:], np.ones(n - 1, bool)).tolist() + [none]
    queue = [(ranks[p], i, p) for i, p in enumerate(pair) if p != none]
    heapq.heapify(queue)
    while queue:
        _, i, p = heapq.heappop(queue)
        if pair[i] != p:
            continue  # one of the two has been merged since
        j = after[i]
        s[i], s[j], pair[j] = merged[p], -1, none
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for a in (before[i], i):
            if a >= 0:
                pair[a] = lookup.get(s[a] * base + s[after[a]], none) if after[a] < n else none
                if pair[a] != none:
                    heapq.heappush(queue, (ranks[pair[a]], a, pair[a]))
    out = np.array(s, sym.dtype)
    left = np.flatnonzero(out >= 0)
    return out[left], left


def merge_words(words: list[str], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one behind the other, and the number of ids of each. A word starts with its mark."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    sym = vocab.chars[points]
    sym[sym < 0] = vocab.other
    point = points.astype(np.int64)  # the character of a symbol that is one, for byte fallback
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    pair = np.full(len(sym), len(vocab.keys), np.int32)  # entry of each symbol with its right neighbour
    if len(sym) > 1:
        pair[:-1] = vocab.pairs(sym[:-1], sym[1:], word[1:] == word[:-1])
    rounds = 0
    while len(sym):
        first = _firsts(word)
        rounds += 1
        if rounds > ROUNDS:  # long runs of marks or letters: a round would merge little of them
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(sym)]):
                out, left = _merge_queue(sym[a:b], vocab) if b - a > 1 else (sym[a:b], np.zeros(1, np.int64))
                done.append((np.full(len(out), word[a]), out, point[a:b][left]))
            break
        rank = vocab.ranks[pair]
        best = np.minimum.reduceat(rank, first)
        counts = np.diff(np.append(first, len(sym)))
        if (best == NONE).any():  # words without a pair leave
            out = np.repeat(best == NONE, counts)
            done.append((word[out], sym[out], point[out]))
            stay = ~out
            word, sym, point, pair, rank = word[stay], sym[stay], point[stay], pair[stay], rank[stay]
            counts, best = counts[best != NONE], best[best != NONE]
            if len(sym) == 0:
                break
        place = np.nonzero(rank == np.repeat(best, counts))[0]
        near = np.concatenate([[False], (place[1:] == place[:-1] + 1)])  # overlapping places are in one word
        run = np.arange(len(place)) - np.maximum.accumulate(np.where(near, 0, np.arange(len(place))))
        leftmost = np.concatenate([[True], word[place[1:]] != word[place[:-1]]])
        place = place[np.where(vocab.safe[rank[place]], run % 2 == 0, leftmost)]
        sym[place] = vocab.merged[pair[place]]
        keep = np.ones(len(sym), bool)
        keep[place + 1] = False
        word, sym, point, pair = word[keep], sym[keep], point[keep], pair[keep]
        moved = place - np.arange(len(place))  # where the merged symbols stand after compaction
        for at in (moved, moved[moved > 0] - 1):
            right = np.minimum(at + 1, len(sym) - 1)
            pair[at] = vocab.pairs(sym[at], sym[right], (at + 1 < len(sym)) & (word[right] == word[at]))
    if not done:
        return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
    word, sym, point = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(word, kind="stable")
    word, sym, point = word[order], sym[order], point[order]
    spelt = np.nonzero(~vocab.is_piece[sym])[0]  # characters without a piece are spelt in bytes
    if len(spelt):
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in point[spelt].tolist()]
        reps = np.ones(len(sym), np.int64)
        reps[spelt] = [len(b) for b in raw]
        starts = np.cumsum(reps) - reps
        word, sym = np.repeat(word, reps), np.repeat(sym, reps)
        places = np.concatenate([np.arange(s, s + len(b)) for s, b in zip(starts[spelt].tolist(), raw)])
        sym[places] = vocab.bytes[np.frombuffer(b"".join(raw), np.uint8)]
    return sym.astype(np.int32), np.bincount(word, minlength=len(words))


def words_of(text: str) -> list[str]:
    """The text's segments without their first mark: what stands between single spaces, or with
    more marks in front where spaces repeat."""
    if not text:
        return []
    if "  " not in text and text[-1] != " " and text[0] != " " and MARK not in text:
        return text.split(" ")
    return [s[1:] for s in _SEGMENT.findall(MARK + text.replace(" ", MARK))]


class Encoder:
    """Encodes texts with a bounded dictionary of words met before."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self._clear()

    def _clear(self):
        self.known, self.held = {}, 0
        self.flat = np.array([self.vocab.bos, self.vocab.eos], np.int32)  # words 0 and 1
        self.start, self.count = np.array([0, 1]), np.array([1, 1])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, begin and end ids included."""
        words, stops = [], []
        for t in texts:
            words += words_of(t)
            stops.append(len(words))
        if len(self.known) > _CACHE_WORDS or self.held > _CACHE_CHARS:
            self._clear()
        fresh = [w for w in dict.fromkeys(words) if w not in self.known]
        if fresh:
            ids, counts = merge_words([MARK + w for w in fresh], self.vocab)
            base = len(self.start)
            self.held += sum(map(len, fresh))
            self.known.update(zip(fresh, range(base, base + len(fresh))))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(counts) - counts])
            self.count = np.concatenate([self.count, counts])
            self.flat = np.concatenate([self.flat, ids])
        index = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        stops = np.array(stops, np.int64)
        index = np.insert(index, np.repeat(stops, 1), 1)  # the end of each text
        index = np.insert(index, np.concatenate([[0], stops[:-1] + np.arange(1, len(stops))]), 0) if len(stops) else index
        counts = self.count[index]
        shift = np.cumsum(counts) - counts
        ids = self.flat[np.repeat(self.start[index] - shift, counts) + np.arange(int(counts.sum()))]
        per_text = np.cumsum(counts)[stops + 2 * np.arange(1, len(stops) + 1) - 1] if len(stops) else []
        return np.split(ids, per_text[:-1]) if len(stops) else []

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids that ``encode`` gives: pieces joined, marks as spaces, the first one dropped."""
        raw = b"".join(map(self.vocab.surface.__getitem__, ids.tolist()))
        return raw[raw[:1] == b" ":].decode("utf-8", "replace")


def encode_decode(docs: DataFrame, model_path: str, text_col: str = "text", ids_name: str = "ids",
                  decoded_name: str = "decoded") -> DataFrame:
    """``docs`` without its text column, with the ids (binary: little-endian unsigned 32-bit
    integers, begin and end ids included) and the text decoded from them.

    Null and empty texts have the begin and end id only and decode to the empty text. One row per
    input row; other columns pass through. The two new names must not occur in ``docs``.
    """
    clash = {ids_name, decoded_name} & (set(docs.columns) - {text_col})
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(model_path))
    at = docs.columns.index(text_col)
    rest = [i for i in range(len(docs.columns)) if i != at]

    def run(batches):
        cache = worker_cache("piece-bpe")
        coder = cache.get(model_path)
        if coder is None:
            coder = cache[model_path] = Encoder(shared.value)
        for batch in batches:
            for part in slices(batch, at, 4 << 20):
                ids = coder.encode([t or "" for t in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in rest), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                     pa.array([coder.decode(x) for x in ids], pa.string())],
                    names=[*(part.schema.names[i] for i in rest), ids_name, decoded_name])

    fields = [docs.schema.fields[i] for i in rest]
    return docs.mapInArrow(run, T.StructType([*fields, T.StructField(ids_name, T.BinaryType()), T.StructField(decoded_name, T.StringType())]))
