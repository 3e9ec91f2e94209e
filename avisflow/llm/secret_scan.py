"""Secret scans with one combined deterministic automaton.

The patterns of all rules are compiled into a single minimal searching automaton over bytes. Many
texts are laid out as lanes of one byte matrix, cut at bytes that send every state back to the
start, and all lanes take one transition per step: each byte is read once, for all rules. Where a
rule's bit shows up, its own small automata give the exact span: the reversed one walks back to the
leftmost start behind the previous match, the forward one on to the longest end.

Rules must be such that of overlapping matches the one that starts first also first becomes
complete; all rules here are (a fixed opening, then a run). A map over the texts, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avisflow.llm.automaton import Automaton, compile_rule, compile_rules
from avisflow.llm.common import slices, text_bytes


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    any_case: bool = False
    least: int = 0         # bytes a match needs, or what follows the match of ``head`` at its start
    head: str = ""


KEYWORD = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
VALUE = "[A-Za-z0-9+/_.=-]"
#: The contract's base rules first, in the order of their kinds; then rules of our own for issued keys.
RULES = (
    Rule("assign", f"{KEYWORD}{VALUE}+", any_case=True, least=6, head=KEYWORD),
    Rule("access", "AKIA[A-Z0-9]+", least=20),
    Rule("hex", "[0-9a-f]{8,}", least=24),
    Rule("github", "gh[opsru]_[A-Za-z0-9]+", least=40),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE = 3
#: Bytes scanned at once, and lanes they are laid out in.
_LANES = 4096


class Scanner:
    """Compiled rules; plain arrays, so it can be broadcast."""

    def __init__(self, rules=RULES):
        self.rules = tuple(rules)
        self.all = compile_rules([(r.pattern, r.any_case) for r in self.rules])
        self.ahead = [compile_rule(r.pattern, r.any_case) for r in self.rules]
        self.back = [compile_rule(r.pattern, r.any_case, reverse=True) for r in self.rules]
        self.heads = [compile_rule(r.head, r.any_case) if r.head else None for r in self.rules]
        step = self.all.step
        resets = (step == 0).all(axis=0)  # classes after which every state is the start
        if not resets.any() or not resets[self.all.classes[10]]:
            raise ValueError("line feeds must end every match")
        self.reset_bytes = resets[self.all.classes]
        width = step.shape[1]
        self.table = (step * width).astype(np.int32).ravel()  # states counted in rows of the table
        self.width = width

    def hits(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offsets behind which some rule's match is complete, and the bits of those rules."""
        n = len(text)
        if n == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lanes = max(1, min(_LANES, n // 64))
        cuts = np.linspace(0, n, lanes + 1).astype(np.int64)[1:-1]
        safe = np.nonzero(self.reset_bytes[text])[0] + 1  # places where the start state is certain
        if len(cuts) and len(safe):
            at = np.searchsorted(safe, cuts)
            cuts = np.unique(safe[at[at < len(safe)]])
            cuts = cuts[cuts < n]
        else:
            cuts = np.zeros(0, np.int64)
        starts = np.concatenate([[0], cuts])
        sizes = np.diff(np.append(starts, n))
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        symbols = self.all.classes[text]
        state = np.zeros(len(starts), np.int32)
        limit = self.all.first_accepting * self.width
        ends, bits = [], []
        live = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")  # lanes with a byte at this step
        for at in range(0, int(sizes[0]), 256):
            wide = int(live[at])
            chunk = np.minimum(starts[:wide, None] + np.arange(at, min(at + 256, int(sizes[0]))), n - 1)
            block = np.ascontiguousarray(symbols[chunk].T)
            for k in range(block.shape[0]):
                m = int(live[at + k])
                now = self.table[state[:m] + block[k, :m]]
                state[:m] = now
                if now.max() >= limit:
                    found = np.nonzero(now >= limit)[0]
                    ends.append(starts[found] + (at + k + 1))
                    bits.append(self.all.accepts[now[found] // self.width])
        if not ends:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends, bits = np.concatenate(ends), np.concatenate(bits)
        order = np.argsort(ends, kind="stable")
        return ends[order], bits[order]

    def spans(self, text: bytes, ends: np.ndarray, bits: np.ndarray) -> list[tuple[str, int, int]]:
        """Exact spans (bytes) of one text from its hits; by start, then rule."""
        out = []
        for r, rule in enumerate(self.rules):
            done = 0
            for end in ends[bits >> r & 1 == 1].tolist():
                if end <= done:
                    continue
                start = _longest(self.back[r], text, end - 1, done - 1, -1)
                if start < 0:
                    continue
                start = end - start
                stop = start + _longest(self.ahead[r], text, start, len(text), 1)
                done = stop
                tail = start + _longest(self.heads[r], text, start, stop, 1) if self.heads[r] else start
                if stop - tail >= rule.least:
                    out.append((start, r, stop))
        return [(self.rules[r].kind, a, b) for a, r, b in sorted(out)]

    def scan(self, texts: list[bytes]) -> list[list[tuple[str, int, int]]]:
        """Spans of each text in code points, end exclusive."""
        joined = b"\n".join(texts)
        ends, bits = self.hits(np.frombuffer(joined, np.uint8))
        stops = np.cumsum([len(t) + 1 for t in texts])
        owner = np.searchsorted(stops, ends - 1, side="right")
        out: list[list] = [[] for _ in texts]
        groups = np.nonzero(np.diff(owner, prepend=-1))[0] if len(owner) else []
        for a, b in zip(groups, np.append(groups[1:], len(owner)) if len(owner) else []):
            i = int(owner[a])
            text = texts[i]
            found = self.spans(text, ends[a:b] - (int(stops[i]) - len(text) - 1), bits[a:b])
            if found and not text.isascii():
                point = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
                # offsets stand at character starts: bytes of a match are ASCII
                found = [(k, int(point[x]), int(point[y])) for k, x, y in found]
            out[i] = found
        return out


def _longest(machine: Automaton, text: bytes, at: int, stop: int, way: int) -> int:
    """Bytes from ``at`` in direction ``way`` (``stop`` excluded) that the longest match takes; -1 if none."""
    state, best, taken = 0, -1, 0
    step, classes, accepts, dead = machine.step, machine.classes, machine.accepts, machine.dead
    while at != stop:
        state = int(step[state, classes[text[at]]])
        if state == dead:
            break
        taken += 1
        if accepts[state]:
            best = taken
        at += way
    return best


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """doc_id, spans (array of kind, start, end in code points; by start, then rule): one row per input row.

    Per kind the matches are leftmost, longest and do not overlap; too short ones are dropped after
    they have taken their place. Null and empty texts have no spans. Repeated rows give repeated
    rows; other columns of ``docs`` are not read; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Scanner(rules))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        scanner = shared.value
        for batch in batches:
            for part in slices(batch):
                found = [[{"kind": k, "start": a, "end": b} for k, a, b in x] for x in scanner.scan(text_bytes(part.column(1)))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, kind)], names=["doc_id", "spans"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    of = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {of}, spans array<struct<kind:string,start:bigint,end:bigint>>")
