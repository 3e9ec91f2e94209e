"""Byte automata for scan rules: pattern -> position automaton -> subset construction -> minimisation.

Patterns know literals, ``\\xHH`` and escaped characters, classes with ranges and negation, groups,
alternatives and the repeats ? * + {m} {m,} {m,n}. They are compiled once on the driver; the
resulting transition arrays are all that the scan needs.
"""

from __future__ import annotations

import numpy as np


class _Nfa:
    def __init__(self):
        self.moves: list[tuple[frozenset[int], int] | None] = []
        self.skips: list[list[int]] = []

    def state(self) -> int:
        self.moves.append(None)
        self.skips.append([])
        return len(self.moves) - 1


def _parse(pattern: str):
    """Syntax tree: ('set', bytes) | ('cat', [..]) | ('alt', [..]) | ('rep', node, least, most)."""
    at = 0

    def char() -> int:
        nonlocal at
        c = pattern[at]
        at += 1
        if c != "\\":
            return ord(c)
        c = pattern[at]
        at += 1
        if c == "x":
            at += 2
            return int(pattern[at - 2:at], 16)
        return ord({"n": "\n", "t": "\t", "r": "\r"}.get(c, c))

    def choice():
        nonlocal at
        arms = [sequence()]
        while at < len(pattern) and pattern[at] == "|":
            at += 1
            arms.append(sequence())
        return arms[0] if len(arms) == 1 else ("alt", arms)

    def sequence():
        items = []
        while at < len(pattern) and pattern[at] not in "|)":
            items.append(repeat(atom()))
        return ("cat", items)

    def atom():
        nonlocal at
        if pattern[at] == "(":
            at += 1
            node = choice()
            at += 1
            return node
        if pattern[at] == "[":
            at += 1
            negated = pattern[at] == "^"
            at += negated
            found: set[int] = set()
            while pattern[at] != "]":
                low = char()
                high = low
                if pattern[at] == "-" and pattern[at + 1] != "]":
                    at += 1
                    high = char()
                found |= set(range(low, high + 1))
            at += 1
            return ("set", frozenset(set(range(256)) - found if negated else found))
        return ("set", frozenset([char()]))

    def repeat(node):
        nonlocal at
        while at < len(pattern) and pattern[at] in "?*+{":
            c = pattern[at]
            at += 1
            if c == "{":
                stop = pattern.index("}", at)
                low, comma, high = pattern[at:stop].partition(",")
                at = stop + 1
                least, most = int(low), (int(low) if not comma else int(high) if high else None)
            else:
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
            node = ("rep", node, least, most)
        return node

    tree = choice()
    if at != len(pattern):
        raise ValueError(f"unbalanced pattern: {pattern}")
    return tree


def _reverse(node):
    if node[0] == "set":
        return node
    if node[0] == "rep":
        return ("rep", _reverse(node[1]), *node[2:])
    parts = [_reverse(x) for x in node[1]]
    return (node[0], parts[::-1] if node[0] == "cat" else parts)


def _any_case(node):
    if node[0] == "set":
        return ("set", frozenset(node[1] | {ord(chr(b).swapcase()) for b in node[1] if b < 128}))
    if node[0] == "rep":
        return ("rep", _any_case(node[1]), *node[2:])
    return (node[0], [_any_case(x) for x in node[1]])


def _build(nfa: _Nfa, node, start: int) -> int:
    """Add ``node`` behind state ``start``; the state it ends in."""
    if node[0] == "set":
        end = nfa.state()
        nfa.moves[start] = (node[1], end)
        # a state has one move: go on from a fresh one
        out = nfa.state()
        nfa.skips[end].append(out)
        return out
    if node[0] == "cat":
        for part in node[1]:
            start = _build(nfa, part, start)
        return start
    if node[0] == "alt":
        end = nfa.state()
        for arm in node[1]:
            first = nfa.state()
            nfa.skips[start].append(first)
            nfa.skips[_build(nfa, arm, first)].append(end)
        return end
    _, inner, least, most = node
    for _ in range(least):
        start = _build(nfa, inner, start)
    if most is None:
        loop, first, end = nfa.state(), nfa.state(), nfa.state()
        nfa.skips[start].append(loop)
        nfa.skips[loop] += [first, end]
        nfa.skips[_build(nfa, inner, first)].append(loop)
        return end
    end = nfa.state()
    nfa.skips[start].append(end)
    for _ in range(most - least):
        first = nfa.state()
        nfa.skips[start].append(first)
        start = _build(nfa, inner, first)
        nfa.skips[start].append(end)
    return end


class Automaton:
    """Minimal deterministic automaton of several patterns: ``classes`` maps a byte to its class,
    ``step[state, class]`` is the next state, ``accepts[state]`` has a bit per pattern. State 0 is
    the start. Searching automata begin a match anywhere; others die in a state without exit."""

    def __init__(self, trees: list, searching: bool):
        nfa = _Nfa()
        root = nfa.state()
        finals = {}
        for i, tree in enumerate(trees):
            first = nfa.state()
            nfa.skips[root].append(first)
            finals[_build(nfa, tree, first)] = i
        sets = {m[0] for m in nfa.moves if m}
        signature: dict[tuple, int] = {}
        self.classes = np.zeros(256, np.uint8)
        for b in range(256):
            key = tuple(b in s for s in sets)
            self.classes[b] = signature.setdefault(key, len(signature))
        example = [int(np.argmax(self.classes == c)) for c in range(len(signature))]

        def closure(states) -> frozenset[int]:
            seen, todo = set(states), list(states)
            while todo:
                for t in nfa.skips[todo.pop()]:
                    if t not in seen:
                        seen.add(t)
                        todo.append(t)
            return frozenset(seen)

        start = closure([root])
        known, rows, bits, todo = {start: 0}, [], [], [start]
        while len(rows) < len(todo):
            here = todo[len(rows)]
            bits.append(sum(1 << finals[s] for s in here if s in finals))
            row = []
            for b in example:
                target = closure([m[1] for s in here if (m := nfa.moves[s]) and b in m[0]])
                if searching:
                    target |= start
                if target not in known:
                    known[target] = len(todo)
                    todo.append(target)
                row.append(known[target])
            rows.append(row)
        step, accepts = np.array(rows, np.int64), np.array(bits, np.int64)
        # Minimisation: refine blocks of states by their own block and those of their successors.
        _, block = np.unique(accepts, return_inverse=True)
        while True:
            _, finer = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)
            finer = finer.ravel()
            if finer.max() == block.max():
                break
            block = finer
        firsts = np.full(block.max() + 1, -1)
        for s in range(len(block) - 1, -1, -1):
            firsts[block[s]] = s
        # The start first, accepting states last, so one comparison finds matches.
        order = sorted(range(len(firsts)), key=lambda b: (b != block[0], bool(accepts[firsts[b]]), b))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.step = place[block[step[firsts[order]]]].astype(np.int32)
        self.accepts = accepts[firsts[order]]
        self.first_accepting = int((self.accepts == 0).sum())
        dead = [s for s in range(len(order)) if (self.step[s] == s).all() and self.accepts[s] == 0]
        self.dead = dead[0] if dead and not searching else -1


def compile_rule(pattern: str, any_case: bool = False, reverse: bool = False, searching: bool = False) -> Automaton:
    return Automaton([_tree(pattern, any_case, reverse)], searching)


def compile_rules(patterns: list[tuple[str, bool]]) -> Automaton:
    """All patterns in one searching automaton; each with its any-case flag."""
    return Automaton([_tree(p, any_case) for p, any_case in patterns], True)


def _tree(pattern: str, any_case: bool, reverse: bool = False):
    tree = _parse(pattern)
    tree = _any_case(tree) if any_case else tree
    return _reverse(tree) if reverse else tree
