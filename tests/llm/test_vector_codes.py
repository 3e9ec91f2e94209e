"""Vector codes against the plain algorithm in Python integers."""

import math
import random

import numpy as np
import pytest
from llm_helpers import EXTRA

from avisflow.llm import vector_codes
from avisflow.llm.common import read


def plain(rows, rounds=vector_codes.ROUNDS):
    """rows: (id, vector, label). Results as the contract states them, without trees."""
    kept = [(i, [math.floor(4096 * x) for x in v], y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(q) for _, q, _ in kept), default=0) // 8) * 8
    kept = [(i, q + [0] * (width - len(q)), y) for i, q, y in kept]
    part = width // 8
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:16]
    books = [[q[p * part:(p + 1) * part] for _, q, _ in first] for p in range(8)]

    def nearest(piece, book):
        d = [sum((a - b) ** 2 for a, b in zip(piece, e)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(8):
            of = [nearest(q[p * part:(p + 1) * part], books[p])[0] for _, q, _ in kept]
            for e in range(len(first)):
                own = [q[p * part:(p + 1) * part] for (_, q, _), o in zip(kept, of) if o == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    out = []
    for i, q, y in kept:
        found = [nearest(q[p * part:(p + 1) * part], books[p]) for p in range(8)]
        out.append((i, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found), y))
    sums = {}
    for _, _, e, y in out:
        sums[y] = sums.get(y, 0) + e
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted(((i, c, e, sums[y]) for i, c, e, y in out), key=key), np.array(books).ravel().tolist()


def run(spark, rows):
    df = spark.createDataFrame([(*r, *[None] * len(EXTRA.split(","))) for r in rows], "vec_id long, embedding array<double>, label int, " + EXTRA)
    codes, books = vector_codes.compress(df)
    out = vector_codes.with_label_errors(codes, books).collect()
    assert len({r["codebooks_sha256"] for r in out}) <= 1
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in out), key=key), books.ravel().tolist()


def vectors(kind, n, width=16):
    rng = random.Random(n)
    if kind == "grid":  # ties and repeats everywhere
        return [[rng.randrange(-2, 3) / 4096 for _ in range(width)] for _ in range(n)]
    if kind == "clusters":
        centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(12)]
        return [[c + rng.gauss(0, 0.02) for c in rng.choice(centres)] for _ in range(n)]
    return [[rng.gauss(0, 0.1) for _ in range(width)] for _ in range(n)]


@pytest.mark.parametrize("kind,n", [("grid", 700), ("clusters", 900), ("noise", 600), ("noise", 5), ("grid", 17)])
def test_equal_to_the_plain_algorithm(spark, kind, n, monkeypatch):
    rows = [(i * 3 % n, v, i % 5 or None) for i, v in enumerate(vectors(kind, n))]
    assert run(spark, rows) == plain(rows)


def test_odd_rows(spark):
    good = vectors("noise", 60, 24)
    rows = [(i, v, None) for i, v in enumerate(good)]
    rows += [(100, None, 1), (101, [None] + good[0][1:], 1), (102, [math.nan] * 24, 1), (103, [math.inf] * 24, 2), (None, good[1], 2), (None, good[2], 2),
             (7, good[3], 3), (7, good[3], 3), (104, [], 4), (105, good[4][:11], 4), (106, [0.0] * 24, 4)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, [(1, None, None)]) == ([], [])
    assert run(spark, []) == ([], [])


def test_components_too_large_fail_with_a_reason(spark):
    with pytest.raises(Exception, match="components must stay below"):
        run(spark, [(1, [1e6] * 8, None)])


def test_trees_hold_every_point_and_own_balls_whole():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (16, 8))
    points = (centres[rng.integers(0, 16, 3000)] + rng.integers(-40, 40, (3000, 8))).astype(np.int64)
    tree = vector_codes.Tree(points)
    assert sorted(tree.order.tolist()) == list(range(3000)) and tree.lo[-1] == 0 and tree.hi[-1] == 3000
    held = points[tree.order]
    for n in range(len(tree.lo)):
        own = held[tree.lo[n]:tree.hi[n]]
        assert np.array_equal(own.sum(0), tree.sums[n])
        assert np.sqrt(((own - tree.centre[n]) ** 2).sum(1)).max() <= tree.radius[n] + 1e-6
        if tree.left[n] >= 0:
            a, b = tree.left[n], tree.right[n]
            assert (tree.lo[a], tree.hi[a], tree.hi[b]) == (tree.lo[n], tree.lo[b], tree.hi[n])
    balls, ball_of, rest, rest_of = vector_codes.owners(tree, held, centres)
    sizes = tree.hi[balls] - tree.lo[balls]
    assert sizes.sum() + len(rest) == 3000 and sizes.sum() > 2900  # tight groups are owned without looking at points
    want = ((held[:, None] - centres[None]) ** 2).sum(2).argmin(1)
    assert all((want[tree.lo[b]:tree.hi[b]] == o).all() for b, o in zip(balls, ball_of)) and (want[rest] == rest_of).all()


def test_query_on_the_given_table(spark):
    from avisflow.llm.queries import op12_vector_codes
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in read(spark, sf, "embeddings").collect()]
    got = sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in op12_vector_codes(spark, sf).collect()), key=str)
    assert got == sorted(plain(rows)[0], key=str)
