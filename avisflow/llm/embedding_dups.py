"""Embedding near-duplicates: random-hyperplane sign hashing, exact cosines, components.

Each of several tables hashes a vector to the signs of its products with some random hyperplanes;
vectors that share a table's bucket are compared by their exact cosine in double precision. A pair
is counted in the first table in which the two agree, so no pair is counted twice although tables
are worked on independently, and no pair leaves its task: tasks hand on each vector's number of new
links and a spanning forest of them.

The hyperplanes per table grow with the number of vectors (buckets of about ``BUCKET`` unrelated
ones), the number of tables follows from the wished recall at the threshold itself (pairs above it
are found more surely still). Equal vectors are collapsed first, by a partially aggregated grouping,
and counted as links of each other. A bucket with very many vectors is cut into blocks whose pairs
are compared in separate cells, each once.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avisflow.llm.common import table
from avisflow.llm.components import connected_components, local_forest

THRESHOLD, RECALL, BUCKET, CELL, SEED = 0.9, 0.998, 256, 2048, 3


def layout(vectors: int, threshold: float = THRESHOLD, recall: float = RECALL, bucket: int = BUCKET) -> tuple[int, int]:
    """(hyperplanes per table, tables) for so many vectors."""
    agree = 1 - math.acos(threshold) / math.pi
    planes = min(30, max(4, math.ceil(math.log2(max(1, vectors) / bucket))))
    return planes, math.ceil(math.log(1 - recall) / math.log(1 - agree ** planes))


def _signature_type(planes: int) -> str:
    return "u1" if planes <= 8 else "<u2" if planes <= 16 else "<u4"


def signatures(x: np.ndarray, planes: int, tables: int, seed: int = SEED) -> np.ndarray:
    """(rows, tables) bucket numbers, in the smallest type that holds them."""
    normals = np.random.default_rng([seed, x.shape[1], planes, tables]).standard_normal((x.shape[1], tables * planes))
    bits = (x @ normals > 0).reshape(len(x), tables, planes)
    return (bits * (1 << np.arange(planes))).sum(2).astype(_signature_type(planes))


def _entries(classes: DataFrame, planes: int, tables: int, keys_only: bool, seed: int, kind: str) -> DataFrame:
    """One row per vector and table: key; with its signatures and components (numbers of ``kind``,
    which holds the input's exactly) unless ``keys_only``."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids, copies = part.column(0), part.column(1)
                lists = [np.array(v, np.float64) for v in part.column(2).to_pylist()]
                sizes = np.array([len(v) for v in lists])
                for dim in np.unique(sizes):
                    rows = np.nonzero(sizes == dim)[0]
                    x = np.stack([lists[i] for i in rows])
                    sig = signatures(x / np.abs(x).max(1, keepdims=True), planes, tables, seed)
                    raw, packed = ([r.tobytes() for r in a] for a in (x.astype(kind), sig))
                    take = pa.array(rows)
                    for t in range(tables):
                        # vectors of different length never meet; the table and the length are part of the key
                        key = pa.array((sig[:, t].astype(np.int64) * tables + t) * 65536 + dim % 65536)
                        cols = [key, ids.take(take)] + ([] if keys_only else
                                                        [copies.take(take), pa.array(packed, pa.binary()), pa.array(raw, pa.binary())])
                        yield pa.RecordBatch.from_arrays(cols, names=["key", "cid", "copies", "sig", "vec"][:len(cols)])

    return classes.select("cid", "copies", "vec").mapInArrow(
        run, "key long, cid long" + ("" if keys_only else ", copies long, sig binary, vec binary"))


def _compare(threshold: float, planes: int, tables: int, kind: str):
    """Within each (key, cell) run: count each pair in the first table that holds it."""
    def cell(key, own, cid, copies, sig, x):
        t, n = (key // 65536) % tables, len(cid)
        links, u, v = np.zeros(n, np.int64), [], []
        x = x / np.abs(x).max(1, keepdims=True)  # squares of very large or small components stay finite
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        for at in range(0, n, 512):
            s = x[at:at + 512] @ x[at:].T
            a, b = np.nonzero(s >= threshold)
            a, b = a + at, b + at
            ok = a < b
            if own[0] != own[-1]:
                ok &= own[a] != own[b]  # a cell of two blocks: pairs inside a block belong to its own cell
            a, b = a[ok], b[ok]
            if len(a) == 0:
                continue
            new = np.ones(len(a), bool)
            for earlier in range(t):
                new &= sig[a, earlier] != sig[b, earlier]
            a, b = a[new], b[new]
            if len(a):
                links += np.bincount(a, copies[b], n).astype(np.int64) + np.bincount(b, copies[a], n).astype(np.int64)
                x_, y_ = local_forest(cid[a], cid[b])
                u.append(x_)
                v.append(y_)
        return links, u, v

    def runs(held):
        key, cells, own, cid, copies, sig, vec = held
        change = np.nonzero((key[1:] != key[:-1]) | (cells[1:] != cells[:-1]))[0] + 1
        ids, counts, u, v = [], [], [], []
        for a, b in zip(np.concatenate([[0], change]), np.append(change, len(key))):
            if b - a < 2:
                continue
            sigs = np.frombuffer(b"".join(sig[a:b]), _signature_type(planes)).reshape(b - a, tables)
            x = np.frombuffer(b"".join(vec[a:b]), kind).reshape(b - a, -1).astype(np.float64)
            order = np.argsort(own[a:b], kind="stable")
            links, x_, y_ = cell(int(key[a]), own[a:b][order], cid[a:b][order], copies[a:b][order], sigs[order], x[order])
            some = links > 0
            ids.append(cid[a:b][order][some])
            counts.append(links[some])
            u += x_
            v += y_
        if ids and sum(map(len, ids)):
            ids, counts = np.concatenate(ids), np.concatenate(counts)
            a, b = local_forest(np.concatenate(u), np.concatenate(v))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([ids, a])), pa.array(np.concatenate([counts, np.zeros(len(a), np.int64)])),
                 pa.array(np.concatenate([ids, b]))], names=["cid", "links", "other"])

    def run(batches):
        held = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                if batch.num_rows == 0:
                    continue
                now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
                now += [np.array(batch.column(i).to_pylist(), object) for i in (5, 6)]
                held = now if held is None else [np.concatenate([a, b]) for a, b in zip(held, now)]
                last = np.nonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))[0]
                cut = int(last[-1]) + 1 if len(last) else 0  # the last run may go on in the next batch
                whole, held = [x[:cut] for x in held], [x[cut:] for x in held]
                if cut:
                    yield from runs(whole)
            elif held is not None and len(held[0]):
                yield from runs(held)

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                    recall: float = RECALL, bucket: int = BUCKET, cell: int = CELL, seed: int = SEED) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per input row.

    Null, empty and zero vectors and such with null, NaN or infinite components link with nothing;
    vectors of different length do not link. n_links counts the other rows within the threshold,
    equal ones included. component_id is the smallest vec_id reachable by links (null ids are never
    the smallest). Rows that repeat a vec_id are separate vectors. Other columns are not read; an
    empty table gives no rows.
    """
    src_kind = vectors.schema[vector_col].dataType.simpleString()
    wide = F.col("v").cast("array<double>")
    bad = F.exists("vec", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    src = (vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v")).select("vec_id", wide.alias("vec"))
           .withColumn("ok", F.coalesce((F.size("vec") > 0) & ~bad & F.exists("vec", lambda c: c != 0), F.lit(False))))
    classes = table(src.where("ok").groupBy("vec").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"))
                    .select(F.monotonically_increasing_id().alias("cid"), "copies", "vec", "first_id"), "vector-classes")
    planes, tables = layout(classes.count(), threshold, recall, bucket)
    kind = "<f4" if src_kind == "array<float>" else "<f8"  # components travel in the input's width
    keys = _entries(classes, planes, tables, True, seed, kind)
    big = table(keys.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > cell)
                .select(F.col("key").alias("big"), F.ceil(F.col("rows") / cell).cast("int").alias("g")), "big-buckets")
    g = F.coalesce("g", F.lit(1))
    block = F.pmod(F.xxhash64("cid"), g).cast("int")
    cells = (_entries(classes, planes, tables, False, seed, kind).join(big, F.col("key") == F.col("big"), "left")
             .withColumn("other", F.explode(F.sequence(F.lit(0), g - 1)))
             .select("key", (F.least(block, "other") * g + F.greatest(block, "other")).alias("cell"), block.alias("own"),
                     "cid", "copies", "sig", "vec"))
    found = table(cells.repartition("key", "cell").sortWithinPartitions("key", "cell")
                  .mapInArrow(_compare(threshold, planes, tables, kind), "cid long, links long, other long"), "vector-links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links")).select(F.col("cid").alias("l_cid"), "links")
    comps = table(connected_components(found.select(F.col("cid").alias("u"), F.col("other").alias("v"))), "vector-components")
    small = classes.select("cid", "copies", "first_id")
    roots = table(comps.join(small, comps.node == small.cid).groupBy("root").agg(F.min("first_id").alias("least_id")), "roots")
    named = table(comps.join(roots, "root").select("node", "least_id"), "named")
    known = table(small.join(links, small.cid == links.l_cid, "left").join(named, small.cid == named.node, "left")
                  .select("cid", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                          F.coalesce("least_id", "first_id").alias("component_id")), "class-results")
    known = table(classes.select("cid", "vec").join(known, "cid").select(F.col("vec").alias("c_vec"), "n_links", "component_id"),
                  "vector-results")
    out = src.withColumn("vec", F.when(F.col("ok"), F.col("vec"))).join(known, F.col("vec") == F.col("c_vec"), "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
