"""Mixing against its rules, the pipeline against its stages, registration and the import guard."""

import os
import subprocess
import sys

import numpy as np
import pytest
from llm_helpers import odd_docs, words

from avisflow.llm import mixing, queries

SF = "/root/testdata/sf0.01"
REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def brute_targets(sizes, total, weights=(3, 1, 2)):
    """Targets in source order by sharing again and again."""
    target, fixed = [0.0] * len(sizes), set()
    while len(fixed) < len(sizes):
        left = total - sum(2 * sizes[i] for i in fixed)
        mass = sum(weights[i % 3] for i in range(len(sizes)) if i not in fixed)
        share = {i: left * weights[i % 3] / mass for i in range(len(sizes)) if i not in fixed}
        over = {i for i, s in share.items() if s >= 2 * sizes[i]}
        if not over:
            for i, s in share.items():
                target[i] = s
            break
        fixed |= over
    return [2.0 * sizes[i] if i in fixed else target[i] for i in range(len(sizes))]


@pytest.mark.parametrize("options", [{}, {"block_words": 3000, "shards": 5}, {"block_words": 500}])
def test_mix_of_the_table(spark, options):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.mix_table(docs, **options).collect()
    sizes = {r["doc_id"]: len(words(r["text"])) for r in docs.collect()}
    assert {r["doc_id"]: r["size"] for r in rows} == sizes and len(rows) == len(sizes)
    of = {}
    for r in rows:
        of.setdefault(r["source"], []).append(r)
        assert r["taken"] == r["size"] * len(r["shards"]) <= 2 * r["size"]
    names = sorted(of, key=lambda s: (s is None, s or ""))
    whole = [sum(r["size"] for r in of[s]) for s in names]
    targets = brute_targets(whole, 1.5 * sum(whole))
    for s, n, t in zip(names, whole, targets):
        assert {r["source_size"] for r in of[s]} == {n}
        assert all(abs(r["target"] - t) < 1e-6 * max(1, t) for r in of[s])
        longest = max(r["size"] for r in of[s])
        assert abs(sum(r["taken"] for r in of[s]) - t) <= max(longest, 0.01 * t)
    again = {r["doc_id"]: tuple(r["shards"]) for r in mixing.mix_table(docs.repartition(3), **options).collect()}
    assert again == {r["doc_id"]: tuple(r["shards"]) for r in rows}


def test_tree_keeps_quotas():
    quotas = np.array([1000, 0, 17, 333, 64])
    dealt = mixing.split_quotas(quotas, 13, np.random.default_rng(0))
    assert (dealt.sum(0) == quotas).all() and dealt.shape == (13, 5)
    assert dealt.sum(1).max() - dealt.sum(1).min() <= 2 * np.log2(13)  # shards are of one size
    share = dealt[:, 0] / dealt.sum(1)
    assert abs(share - 1000 / quotas.sum()).max() < 0.15  # and of the mixture's proportions


def test_mix_rows_and_shards(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    table = {r["doc_id"]: len(r["shards"]) for r in mixing.mix_table(docs, block_words=2000).collect()}
    mixed = mixing.mix(docs, block_words=2000)
    assert mixed.columns == docs.columns
    count = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert count == {i: n for i, n in table.items() if n}


def test_mix_odd_cases(spark):
    docs = odd_docs(spark)
    rows = mixing.mix_table(docs).collect()
    assert len(rows) == docs.count()
    assert [r["source_size"] for r in rows if r["source"] == "c"] == [30000]
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    ties = [r["taken"] for r in rows if r["doc_id"] == 16]
    assert len(ties) == 2 and ties[0] == ties[1]
    assert mixing.mix(docs).columns == docs.columns and mixing.mix(docs).count() == sum(len(r["shards"]) for r in rows)
    assert mixing.mix_table(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


def test_blank_rows_stay_out_of_the_running_sum(spark):
    keyed = spark.createDataFrame([(0, 0, i % 3, i) for i in range(30)], "src int, block long, size long, place long")
    cuts = spark.createDataFrame([(0, 0, 5.0)], "c_src int, c_block long, need double")
    assert sorted(r["size"] for r in mixing._cut_rows(keyed, cuts).collect()) == [1] * 10 + [2] * 10
    docs = spark.createDataFrame([(i, "a b c" if i % 50 == 0 else None, "s") for i in range(2000)] + [(9000, "a " * 120, "t")],
                                 "doc_id long, text string, source string")
    rows = mixing.mix_table(docs).collect()
    taken = sum(r["taken"] for r in rows if r["source"] == "s")
    target = next(r["target"] for r in rows if r["source"] == "s")
    assert len(rows) == 2001 and abs(taken - target) <= 3


# -- pipeline --------------------------------------------------------------------
def test_pipeline_stages(spark):
    sys.path.insert(0, REPO)
    import corpus_pipeline as cp
    from test_dedup_ops import brute_exact, brute_simhash

    docs = cp.read(spark, SF, "documents")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = [docs]
    for name, stage in cp.STAGES[:4]:
        kept.append(cp.table(stage(spark, kept[-1], SF), f"test-{name}"))
        assert kept[-1].columns == docs.columns
    good, exact, near, mixed = kept[1:]
    stay = {r["doc_id"] for r in good.select("doc_id").collect()}
    rejected = [q for i, q in labels.items() if i not in stay]
    assert np.mean(rejected) < 0.2 and len(rejected) >= 0.8 * sum(q == 0 for q in labels.values())
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    want = {i for i, keep, *_ in brute_exact(rows) if i == keep}
    assert {r["doc_id"] for r in exact.collect()} == want
    rows = [(r["doc_id"], r["text"]) for r in exact.collect()]
    want = {i for i, _, root in brute_simhash(rows) if i == root}
    assert {r["doc_id"] for r in near.collect()} == want
    taken = {r["doc_id"]: len(r["shards"]) for r in mixing.mix_table(near).collect()}
    final = cp.STAGES[4][1](spark, mixed, SF)
    count = {r["doc_id"]: r["count"] for r in final.groupBy("doc_id").count().collect()}
    assert count == {i: n for i, n in taken.items() if n}
    assert final.select("doc_id", "ids_sha256").distinct().count() == len(count)


def test_pipeline_of_odd_rows(spark, tmp_path):
    import corpus_pipeline as cp
    odd_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).columns == ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256"]
    empty = tmp_path / "empty"
    odd_docs(spark).limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{empty}/labels.parquet")
    assert cp.run(spark, str(empty)).count() == 0


def test_quality_stage_without_a_network_rejects_nothing(spark, tmp_path):
    import corpus_pipeline as cp
    docs = odd_docs(spark)
    for name, rows in (("none", []), ("few", [(1, 0), (2, 1)]), ("one_kind", [(i, 0) for i in range(1, 18)])):
        spark.createDataFrame(rows, "doc_id long, quality int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        kept = cp.quality_filter(spark, docs, f"{tmp_path}/{name}")
        assert kept.columns == docs.columns and kept.count() == docs.count()


# -- registration ----------------------------------------------------------------
def test_fourteen_queries_are_registered():
    assert len(queries.QUERIES) == 14 and sum(n.startswith("op") for n in queries.QUERIES) == 13


def test_entry_without_the_subpackage(tmp_path):
    import shutil
    shutil.copytree(REPO, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(any(n.startswith('op') for n in e.queries()), len(e.queries()) > 50)"],
                         cwd=tmp_path / "repo", env=dict(os.environ, PYTHONPATH=str(tmp_path / "repo")), capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == ["False", "True"], out.stderr[-1500:]


def test_oracles_equal_queries(spark):
    import duckdb

    from avisflow.llm.oracle import SQL
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    for name, sql in SQL.items():
        want = con.execute(sql)
        columns = sorted(d[0] for d in want.description)
        at = [[d[0] for d in want.description].index(c) for c in columns]
        want = sorted(tuple(r[i] for i in at) for r in want.fetchall())
        assert sorted(tuple(r[c] for c in columns) for r in queries.QUERIES[name](spark, SF).collect()) == want
