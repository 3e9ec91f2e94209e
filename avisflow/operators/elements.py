"""Repeated elements of raw pages: a tag-depth scan that returns fields inside each element's own span.

An element reaches from its tag to the end tag that balances its own name (to the page's end if none
does), so nested elements of any name neither end it early nor take a sibling's fields. Pages are
independent, so the scan is a map over Arrow batches; texts are shaped by built-in expressions after.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

# ---------------------------------------------------------------------------
# Elements without content or whose content is no markup, the patterns of a tag, and the
# rows handed on at once.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
RAW = ("script", "style")
ROWS_AT_ONCE = 256
NAME = r"^</?([A-Za-z][A-Za-z0-9]*)"
CLASS = r"""(?i)\sclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
LABEL = r"""(?i)\saria-label\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
# ---------------------------------------------------------------------------

_NAME, _CLASS, _LABEL = (re.compile(p, re.ASCII) for p in (NAME, CLASS, LABEL))
_BLOCK_END = {name: re.compile(rf"</{name}\s*>", re.I | re.ASCII) for name in RAW}
_BLOCK = re.compile(r"<(script|style)\b", re.I | re.ASCII)


def _tags(html: str):
    """(start, end) of every tag, comment and raw block, in one pass: a missing end is looked for once."""
    at, missing = html.find("<"), set()
    while at >= 0:
        end = -1
        block = _BLOCK.match(html, at)
        if html.startswith("<!--", at) and "comment" not in missing:
            end = html.find("-->", at + 4)
            end = end + 3 if end >= 0 else -1
            if end < 0:
                missing.add("comment")
        elif block and block[1].lower() not in missing:
            found = _BLOCK_END[block[1].lower()].search(html, block.end())
            end = found.end() if found else -1
            if end < 0:
                missing.add(block[1].lower())
        if end < 0:
            end = html.find(">", at) + 1
            if not end:
                return
        yield at, end
        at = html.find("<", end)


def _value(pattern: re.Pattern, tag: str) -> str | None:
    m = pattern.search(tag)
    return next((g for g in m.groups() if g is not None), "") if m else None


def marked_elements(html: str) -> list[tuple[int, int, set, str | None]]:
    """(start, end of the content, classes, aria-label) of the elements with a class or a label, in
    page order; nested ones follow the one that holds them."""
    out: list[list] = []
    open_: dict[str, list] = {}
    for start, end in _tags(html):
        tag = html[start:end]
        m = _NAME.match(tag)
        if not m:
            continue
        name = m[1].lower()
        if tag[1] == "/":
            stack = open_.get(name)
            if stack:
                element = stack.pop()
                if element:
                    element[1] = start
            continue
        head = tag[:tag.index(">") + 1]  # of a raw block
        classes, label = _value(_CLASS, head), _value(_LABEL, head)
        element = None
        leaf = name in VOID or name in RAW or tag.endswith("/>")
        if classes is not None or label is not None:
            element = [end, end if leaf else len(html), set((classes or "").split()), label]
            out.append(element)
        if not leaf:
            open_.setdefault(name, []).append(element)
    return [tuple(e) for e in out]


def nested_fields(html: str, containers: Sequence[str], fields: dict[str, Sequence[tuple[str, str]]]):
    """One list of field candidates per container element. ``containers`` are class names, the first
    that occurs on the page decides. A field's selectors are tried in the given order, each gives the
    first element inside: ("class", c) its content, ("class_label", c) its label, ("label", s) the
    first label that holds s."""
    elements = marked_elements(html)
    chosen = next((c for c in containers if any(c in e[2] for e in elements)), None)
    for i, (start, end, classes, _) in enumerate(elements):
        if chosen is None or chosen not in classes:
            continue
        wanted = [(f, n, kind, what) for f, selectors in enumerate(fields.values()) for n, (kind, what) in enumerate(selectors)]
        found = [[None] * len(s) for s in fields.values()]
        for s, e, own, label in elements[i + 1:]:
            if s > end or not wanted:
                break
            left = []
            for f, n, kind, what in wanted:
                if (label is not None and what in label) if kind == "label" else what in own:
                    found[f][n] = html[s:e] if kind == "class" else label
                else:
                    left.append((f, n, kind, what))
            wanted = left
        yield found


def _element_batches(batches, key: str, containers: Sequence[str], fields: dict[str, Sequence[tuple[str, str]]]):
    """Rows of ``repeated_elements`` for batches of (key, page). A page at a time and about ROWS_AT_ONCE
    rows are Python objects, however many pages a batch has or elements a page."""
    rows: list[tuple] = []

    def out(kind):
        part = pa.RecordBatch.from_arrays(
            [pa.array([k for k, _, _ in rows], kind), pa.array([n for _, n, _ in rows], pa.int32()),
             *(pa.array([found[i] for *_, found in rows], pa.list_(pa.string())) for i in range(len(fields)))], names=[key, "position", *fields])
        rows.clear()
        return part

    for batch in batches:
        kind = batch.schema.field(0).type
        for i in range(batch.num_rows):
            k = batch.column(0)[i].as_py()
            for position, found in enumerate(nested_fields(batch.column(1)[i].as_py() or "", containers, fields)):
                rows.append((k, position, found))
                if len(rows) >= ROWS_AT_ONCE:
                    yield out(kind)
        yield out(kind)


def repeated_elements(pages: DataFrame, key: str, html: str, containers: Sequence[str], fields: dict[str, Sequence[tuple[str, str]]]) -> DataFrame:
    """key, position (from 0) and, per field, the candidates of its selectors (null where none):
    one row per container element. Null pages and pages without one give none."""
    src = pages.select(key, html)
    schema = T.StructType([src.schema[key], T.StructField("position", T.IntegerType()),
                           *(T.StructField(f, T.ArrayType(T.StringType())) for f in fields)])
    return src.mapInArrow(lambda batches: _element_batches(batches, key, containers, fields), schema)
