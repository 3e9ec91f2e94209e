"""SimHash near-duplicates through multi-index hashing.

A fingerprint's 64 bits are cut into segments. Two fingerprints that differ in at most ``bits``
places differ in at most ``bits // segments`` places within one segment, so looking up the small
Hamming ball around each segment value finds every such pair; the complete distance of each
candidate is then computed. Links become components.

Scale: equal fingerprints are collapsed by a partially aggregated grouping first. Table entries and
probes meet per (segment, value); a value with very many of both is cut into cells of bounded size
that every pair still meets in exactly once, and each task hands on a spanning forest of the links
it verified, never the pairs. With more distinct fingerprints, fewer and wider segments with larger
balls are used (``segments_for``): exact at every setting, the choice only moves work.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avisflow.llm.common import slices, table, text_bytes
from avisflow.llm.components import connected_components, local_forest

SHINGLE_WORDS, MAX_BITS, SEED = 4, 4, 42
#: Entries of one cell (table rows and probes) beyond which a value is cut further.
CELL = 8192
_PAIRS_AT_ONCE = 1 << 20


def fingerprint(text: bytes, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of the word shingles, repeats included; fewer words than one shingle: of the
    whole sequence; no word: zero. Words lie between ASCII white space, A-Z count as a-z."""
    parts = text.lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(line, seed)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    n = len(parts) - words + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        cut = slice(at, min(n, at + (1 << 16)))
        hashes = np.array([digest(line[a:b], seed) for a, b in
                           zip(starts[cut].tolist(), ends[cut.start + words - 1:cut.stop + words - 1].tolist())], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long; null texts count as empty."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                fps = np.fromiter((fingerprint(t, words, seed) for t in text_bytes(part.column(1))), "<u8", part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view("<i8"))], names=["doc_id", "fp"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, fp long")


def segments_for(distinct: int, bits: int) -> int:
    """Three segments probe about a dozen values each and meet distinct / 2^21 unrelated rows per
    probe; two probe some 270 each and meet distinct / 2^32. Two are less work from some 2^25 on."""
    return 3 if distinct < 1 << 25 or bits < 2 else 2


def _layout(segments: int) -> list[tuple[int, int]]:
    cuts = [64 * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _balls(width: int, radius: int) -> list[tuple[int, int]]:
    """(mask, its highest bit) of every flip of up to ``radius`` of ``width`` bits; the empty flip first."""
    masks = [(0, 0)]
    for r in range(1, radius + 1):
        for places in itertools.combinations(range(width), r):
            masks.append((sum(1 << p for p in places), 1 << places[-1]))
    return masks


def _entries(fps: DataFrame, segments: int, bits: int) -> DataFrame:
    """(key, kind, fp): kind 0 are table rows, 1 probes. Of two segment values only the one that
    has the highest differing bit set probes the other, so half of each ball is enough."""
    layout, radius = _layout(segments), bits // segments
    balls = [_balls(width, radius) for _, width in layout]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                fp = batch.column(0).slice(at, 2048).to_numpy(zero_copy_only=False).view(np.uint64)
                for s, (shift, width) in enumerate(layout):
                    value = ((fp >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
                    keys, kinds, own = [value], [np.zeros(len(fp), np.int8)], [fp]
                    for mask, top in balls[s]:
                        probing = value & top != 0 if mask else np.ones(len(fp), bool)
                        keys.append(value[probing] ^ mask)
                        kinds.append(np.ones(int(probing.sum()), np.int8))
                        own.append(fp[probing])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys) * segments + s), pa.array(np.concatenate(kinds)),
                         pa.array(np.concatenate(own).view(np.int64))], names=["key", "kind", "fp"])

    return fps.select("fp").mapInArrow(run, "key long, kind byte, fp long")


def _verify(bits: int):
    """Compare table rows and probes of each (key, cell) run; hand on a forest of the links."""
    def whole_runs(run_of, kind, fp):
        n_runs = int(run_of[-1]) + 1
        tables = np.bincount(run_of[kind == 0], minlength=n_runs)
        first = np.searchsorted(run_of, np.arange(n_runs))
        probes = np.nonzero((kind == 1) & (tables[run_of] > 0))[0]
        if len(probes) == 0:
            return [], []
        each = tables[run_of[probes]]
        u, v = [], []
        stops = np.cumsum(each)
        at = 0
        while at < len(probes):
            to = max(at + 1, int(np.searchsorted(stops, (stops[at - 1] if at else 0) + _PAIRS_AT_ONCE, "right")))
            reps = each[at:to]
            left = np.repeat(probes[at:to], reps)
            right = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps) + first[run_of[left]]
            diff = fp[left] ^ fp[right]
            near = (diff != 0) & (np.bitwise_count(diff) <= bits)
            if near.any():
                a, b = local_forest(fp[left[near]].view(np.int64), fp[right[near]].view(np.int64))
                u.append(a)
                v.append(b)
            at = to
        return u, v

    def run(batches):
        held = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None and batch.num_rows == 0:
                continue
            if batch is None:
                if held is None:
                    break
                key, cell, kind, fp = held
                cut = len(key)
            else:
                key, cell, kind, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
                fp = fp.view(np.uint64)
                if held is not None:
                    key, cell, kind, fp = (np.concatenate([a, b]) for a, b in zip(held, (key, cell, kind, fp)))
                last = np.nonzero((key != key[-1]) | (cell != cell[-1]))[0]
                cut = int(last[-1]) + 1 if len(last) else 0  # the last run may go on in the next batch
                held = tuple(x[cut:] for x in (key, cell, kind, fp))
            if cut == 0:
                continue
            change = (key[1:cut] != key[:cut - 1]) | (cell[1:cut] != cell[:cut - 1])
            u, v = whole_runs(np.concatenate([[0], np.cumsum(change)]), kind[:cut], fp[:cut])
            if u:
                a, b = local_forest(np.concatenate(u), np.concatenate(v))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["u", "v"])

    return run


def near_links(fps: DataFrame, bits: int = MAX_BITS, segments: int | None = None, cell: int = CELL) -> DataFrame:
    """(u, v) forest edges over the distinct values of ``fps.fp`` that connect exactly what links
    at ``bits`` or fewer differing bits connect."""
    segments = segments or segments_for(fps.count(), bits)
    entries = _entries(fps, segments, bits)
    # Values whose table rows and probes exceed a cell: g row blocks by g probe blocks.
    big = table(entries.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min("kind").alias("least"))
                .where((F.col("rows") > cell) & (F.col("least") == 0))
                .select(F.col("key").alias("big"), F.ceil(F.col("rows") / cell).cast("int").alias("g")), "big-values")
    g, part = F.coalesce("g", F.lit(1)), F.pmod(F.xxhash64("fp"), F.coalesce("g", F.lit(1))).cast("int")
    cells = (entries.join(big, entries.key == big.big, "left")
             .withColumn("other", F.explode(F.sequence(F.lit(0), g - 1)))
             .select("key", F.when(F.col("kind") == 0, part * g + F.col("other"))
                     .otherwise(F.col("other") * g + part).alias("cell"), "kind", "fp"))
    return (cells.repartition("key", "cell").sortWithinPartitions("key", "cell", "kind")
            .mapInArrow(_verify(bits), "u long, v long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                    bits: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per input row.

    Null and blank texts have fingerprint zero and link like any other. component_id is the
    smallest doc_id reachable by links; null ids are never the smallest, and a component of null
    ids only has component_id null. Rows that repeat a doc_id are equal members. Other columns of
    ``docs`` are not read; an empty table gives no rows.
    """
    fps = table(fingerprints(docs, id_col, text_col, words, seed), "fingerprints")
    classes = table(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    comps = table(connected_components(near_links(classes, bits)), "components")
    roots = table(comps.join(classes, comps.node == classes.fp).groupBy("root").agg(F.min("first_id").alias("least_id")),
                  "roots")
    named = table(comps.join(roots, "root").select("node", "least_id"), "named")
    classes = table(classes.join(named, classes.fp == named.node, "left")
                    .select(F.col("fp").alias("class_fp"), F.coalesce("least_id", "first_id").alias("component_id")), "class-ids")
    return (fps.join(classes, fps.fp == classes.class_fp)
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))
