"""Line de-duplication: lines that many documents share stay in one document only.

Lines are normalised and hashed where the text is read; per document each hash leaves once, as two
64-bit halves of a 128-bit digest, and distinct documents per hash are counted with partial sums
before the shuffle. The hashes over the threshold are joined back to the (hash, document) pairs
from a written table, so a line that a third of all documents hold is split by Spark; each document
then gets the list of its dropped lines and is put together again by position. The texts move once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avisflow.llm.common import ASCII_SPACE, slices, table, text_bytes

MIN_CHARS, MIN_DOCS = 40, 5


def line_key(line: bytes) -> bytes:
    """The line without ASCII white space at its ends, A-Z as a-z."""
    return line.strip(ASCII_SPACE).lower()


def _long_key(line: bytes, least: int) -> bytes | None:
    key = line_key(line)
    if len(key) < least or (not key.isascii() and len(key.decode("utf-8", "replace")) < least):
        return None
    return key


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id, t1, t2): each long line key of a row once. ``docs`` has doc_id, t1, t2 and text."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                raw, rows = [], []
                for i, text in enumerate(text_bytes(part.column(3))):
                    keys = {k for k in (_long_key(x, min_chars) for x in text.split(b"\n")) if k is not None}
                    raw.extend(xxhash.xxh3_128_digest(k) for k in keys)
                    rows.extend([i] * len(keys))
                if rows:
                    halves = np.frombuffer(b"".join(raw), "<i8").reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()),
                         *(part.column(c).take(pa.array(np.array(rows, np.int64))) for c in range(3))], names=["h1", "h2", "doc_id", "t1", "t2"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "t1", "t2", "text").mapInArrow(run, f"h1 long, h2 long, doc_id {kind}, t1 long, t2 long")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text: one row per input row.

    A key of at least ``min_chars`` code points under at least ``min_docs`` doc_ids loses its lines
    everywhere but in the largest doc_id that holds it. Null or empty text: one empty line. Rows that
    repeat a doc_id count as one document; those of the largest doc_id all keep the line. Null ids
    count as no document and are never the largest, but lose the lines that others share.
    Other columns of ``docs`` are not read; an empty table gives no rows.
    """
    # a row is known by its id and two hashes of its text: rows that share an id, or have none, keep lists of their own
    src = docs.select(F.col(id_col).alias("doc_id"), *(F.xxhash64(F.lit(seed), F.col(text_col)).alias(f"t{seed}") for seed in (1, 2)),
                      F.col(text_col).alias("text"))
    held = table(line_hashes(src, min_chars), "line-hashes")
    common = table(held.groupBy("h1", "h2").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keeper"))
                   .where(F.col("n") >= min_docs).select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), "keeper"), "common-lines")
    drops = (held.join(common, (held.h1 == common.c1) & (held.h2 == common.c2))
             .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
             .groupBy("doc_id", "t1", "t2").agg(F.collect_set(F.struct("h1", "h2")).alias("drops")))
    drops = table(drops.select(F.col("doc_id").alias("drop_id"), F.col("t1").alias("u1"), F.col("t2").alias("u2"), F.col("drops.h1").alias("d1"), F.col("drops.h2").alias("d2")), "drops")

    def rebuild(batches):
        for batch in batches:
            for part in slices(batch, 1):
                kept, lines, dropped = [], [], []
                firsts, seconds = part.column(2).to_pylist(), part.column(3).to_pylist()
                for i, text in enumerate(text_bytes(part.column(1))):
                    all_lines = text.split(b"\n")
                    stay = all_lines
                    if firsts[i]:
                        gone = np.array([firsts[i], seconds[i]], "<i8").T.tobytes()
                        gone = {gone[j:j + 16] for j in range(0, len(gone), 16)}
                        stay = [x for x in all_lines
                                if (k := _long_key(x, min_chars)) is None or xxhash.xxh3_128_digest(k) not in gone]
                    kept.append(b"\n".join(stay))
                    lines.append(len(all_lines))
                    dropped.append(len(all_lines) - len(stay))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()),
                     pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept_text"])

    kind = src.schema["doc_id"].dataType.simpleString()
    # a hash join: the lists are the small side, and the texts need no sort
    same = src.doc_id.eqNullSafe(drops.drop_id) & (src.t1 == drops.u1) & (src.t2 == drops.u2)
    return (src.join(drops.hint("shuffle_hash"), same, "left").select("doc_id", "text", "d1", "d2")
            .mapInArrow(rebuild, f"doc_id {kind}, n_lines long, n_dropped long, kept_text string"))
