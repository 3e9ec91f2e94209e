"""Exact, SimHash, line and embedding de-duplication against brute force."""

import hashlib

import numpy as np
import pytest
import xxhash
from llm_helpers import components, lower, odd_docs, words
from hypothesis import given, settings
from hypothesis import strategies as st

from avisflow.llm import block_naming, embedding_dups, lines, queries, simhash
from avisflow.llm.components import connected_components, local_forest

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- components ----------------------------------------------------------------
def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50), (50, 100), (7, 7), (200, 201), (200, 202), (-5, 300)] + [(1000, i) for i in range(500, 560)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(41)} | {100: 50, 50: 50, 200: 200, 201: 200, 202: 200, -5: -5, 300: -5} | {i: 500 for i in [1000, *range(500, 560)]}
    assert got == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=25))
@settings(max_examples=60, deadline=None)
def test_local_forest_keeps_connections(edges):
    u, v = (np.array([e[i] for e in edges], np.int64) for i in (0, 1))
    a, b = local_forest(u, v)
    assert components(13, edges) == components(13, list(zip(a.tolist(), b.tolist())))


# -- exact -----------------------------------------------------------------------
def brute_exact(rows):
    best, size = {}, {}
    for i, t, *_ in rows:
        t = t or ""
        size[t] = size.get(t, 0) + 1
        best[t] = i if best.get(t) is None else max(best[t], i if i is not None else best[t])
    return [(i, best[t or ""], size[t or ""], i == best[t or ""], sha(t or "")) for i, t, *_ in rows]


def key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.mark.parametrize("block", [3, 64, 8192])
def test_exact_odd_cases(spark, block):
    from llm_helpers import ODD_TEXTS
    got = [tuple(r) for r in block_naming.exact_dedup(odd_docs(spark), block_chars=block).collect()]
    assert sorted(got, key=key) == sorted(brute_exact(ODD_TEXTS), key=key)


def test_exact_near_misses_and_heavy_blocks(spark):
    base = "abcdefgh" * 20
    rows = [(i, base if i % 3 else base[:i % 160] + "X" + base[i % 160 + 1:], "s") for i in range(400)]
    rows += [(1000 + i, base[:i], "s") for i in range(160)] + [(2000 + i, base, "s") for i in range(200)]
    got = [tuple(r) for r in block_naming.exact_dedup(odd_docs(spark, rows), block_chars=8).collect()]
    assert sorted(got, key=key) == sorted(brute_exact(rows), key=key)


def test_exact_plan_is_native(spark):
    plan = block_naming.exact_dedup(odd_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- simhash ---------------------------------------------------------------------
def brute_fingerprint(text):
    w = words(lower(text))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_simhash(rows):
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    edges = [(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4]
    root = components(len(rows), edges)
    ids = {}
    for r, (i, *_) in zip(root, rows):
        if i is not None:
            ids[r] = min(ids.get(r, i), i)
    return [(i, f"{f:016x}", ids.get(r)) for (i, *_), f, r in zip(rows, fps, root)]


def test_simhash_odd_cases(spark):
    from llm_helpers import ODD_TEXTS
    got = [tuple(r) for r in simhash.near_duplicates(odd_docs(spark)).collect()]
    assert sorted(got, key=key) == sorted(brute_simhash(ODD_TEXTS), key=key)


def test_simhash_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [tuple(r) for r in queries.op8_simhash(spark, SF).collect()]
    assert sorted(got) == sorted(brute_simhash(rows))


@pytest.mark.parametrize("segments,bits,cell", [(3, 4, 8192), (2, 4, 8192), (3, 4, 5), (3, 7, 50), (5, 4, 3)])
def test_links_find_every_close_pair(spark, segments, bits, cell):
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 1 << 63, 12).tolist()
    fps = {0, (1 << 64) - 1}
    for c in centres:
        for _ in range(25):
            x = c
            for b in rng.choice(64, int(rng.integers(0, 9)), replace=False).tolist():
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    at = {x: i for i, x in enumerate(signed)}
    found = [(at[r["u"]], at[r["v"]]) for r in simhash.near_links(df, bits, segments, cell).collect()]
    edges = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= bits]
    assert all((a, b) in set(edges) or components(len(fps), edges)[a] == components(len(fps), edges)[b] for a, b in found)
    assert components(len(fps), found) == components(len(fps), edges)


def test_segment_choice():
    assert simhash.segments_for(10, 4) == 3 and simhash.segments_for(1 << 30, 4) == 2


# -- lines -----------------------------------------------------------------------
def brute_lines(rows, min_chars=40, min_docs=5):
    def keys(t):
        return [lower(x.strip(" \t\n\x0b\x0c\r")) for x in (t or "").split("\n")]
    count, keeper = {}, {}
    for i, t, *_ in rows:
        for k in {k for k in keys(t) if len(k) >= min_chars}:
            count[k] = count.get(k, 0) + 1
            if i is not None:
                keeper[k] = max(keeper.get(k, i), i)
    out = []
    for i, t, *_ in rows:
        raw = (t or "").split("\n")
        stay = [x for x, k in zip(raw, keys(t)) if count.get(k, 0) < min_docs or i == keeper.get(k)]
        out.append((i, len(raw), len(raw) - len(stay), "\n".join(stay)))
    return out


LINES = ["Shared line with more than forty code points, I think so", "  shared LINE with more than forty code points, i think so\t",
         "é" * 40, "É" * 40, "é" * 39, "short", "", "x" * 40, "another common passage that is long enough to count here"]


def test_lines_odd_cases(spark):
    rng = np.random.default_rng(0)
    rows = [(int(i), "\n".join(rng.choice(LINES, rng.integers(0, 6)).tolist()), "s") for i in rng.permutation(60)]
    rows += [(100, None, "s"), (None, LINES[0], "s"), (101, LINES[0] + "\n" + LINES[1], "s"), (101, LINES[0], "s"), (102, "\n".join(LINES * 200), "s")]
    got = [tuple(r) for r in lines.dedup_lines(odd_docs(spark, rows)).collect()]
    assert sorted(got, key=key) == sorted(brute_lines(rows), key=key)


def test_lines_count_documents_not_rows(spark):
    rows = [(i, LINES[0], "s") for i in (1, 1, 1, 2, 2, None, None)]
    assert {r["n_dropped"] for r in lines.dedup_lines(odd_docs(spark, rows)).collect()} == {0}
    rows += [(i, LINES[0], "s") for i in (3, 4, 5)]
    got = [(r["doc_id"], r["n_dropped"]) for r in lines.dedup_lines(odd_docs(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(((i, int(i != 5)) for i, *_ in rows), key=str)


# -- embeddings ------------------------------------------------------------------
def brute_vectors(rows, threshold=0.9):
    def good(v):
        return v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)
    unit = [np.array(v, float) / np.abs(np.array(v, float)).max() if good(v) else None for _, v in rows]
    unit = [None if v is None else v / np.linalg.norm(v) for v in unit]
    edges = [(a, b) for a in range(len(rows)) for b in range(a) if unit[a] is not None and unit[b] is not None
             and len(unit[a]) == len(unit[b]) and float(unit[a] @ unit[b]) >= threshold]
    links = [0] * len(rows)
    for a, b in edges:
        links[a] += 1
        links[b] += 1
    root, least = components(len(rows), edges), {}
    for r, (i, _) in zip(root, rows):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return [(i, n, least.get(r), i == least.get(r)) for (i, _), n, r in zip(rows, links, root)]


@pytest.mark.parametrize("cell", [2048, 7])
def test_vectors_odd_cases_and_recall(spark, cell):
    rng = np.random.default_rng(5)
    rows = [(0, None), (1, []), (2, [0.0] * 8), (3, [1.0, None] + [0.0] * 6), (4, [float("nan")] * 8), (5, [float("inf")] + [1.0] * 7),
            (6, [1.0, 2.0]), (7, [2.0, 4.0]), (8, [1e300] * 8), (9, [1e-300] * 8), (None, [1.0] * 8), (None, [-1.0] * 8), (10, [3.0] * 8), (10, [3.0] * 8)]
    n = 100
    for _ in range(20):
        c = rng.standard_normal(8)
        for _ in range(int(rng.integers(1, 30))):
            rows.append((n, (c + rng.standard_normal(8) * rng.choice([0.0, 0.02, 0.3])).tolist()))
            n += 1
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in rows]
    df = spark.createDataFrame([(i, v, 0, 1, "k") for i, v in rows], "vec_id long, embedding array<double>, label int, cid long, key string")
    got = sorted([tuple(r) for r in embedding_dups.near_duplicates(df, cell=cell).collect()], key=key)
    want = sorted(brute_vectors([(i, v) for i, v in rows]), key=key)
    assert sum(g[1] for g in got) <= sum(w[1] for w in want)  # no link below the threshold
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want)
    assert len(got) == len(want) and sum(g == w for g, w in zip(got, want)) >= 0.97 * len(want)


def test_vectors_whole_table(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in queries.op3_embedding_dups(spark, SF).collect()) == sorted(brute_vectors(rows))


# -- empty tables ----------------------------------------------------------------
def test_empty_tables(spark):
    none = odd_docs(spark).limit(0)
    for op in (block_naming.exact_dedup, simhash.near_duplicates, lines.dedup_lines):
        assert op(none).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dups.near_duplicates(vectors).count() == 0
