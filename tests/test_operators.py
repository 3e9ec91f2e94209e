import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import Window, functions as F

from avisflow.operators import checks
from avisflow.operators.dedup import latest_per_key
from avisflow.operators.ranking import global_rank
from avisflow.operators.shares import partition_aggregate, share_of_total, share_within
from support import rows


def test_latest_per_key_undated_copy_wins_and_ties_are_stable(spark):
    df = spark.createDataFrame([
        ("k1", "2024-01-02", 10, "a"), ("k1", None, 12, "b"), ("k1", "2024-01-03", 9, "c"),
        ("k2", "2024-01-01", 13, "d"), ("k2", "2024-01-01", 11, "e"),
        ("k3", "2023-05-05", 5, "f"),
    ], "k string, d string, n int, id string")
    out = latest_per_key(df, ["k"], [F.col("d").desc_nulls_first(), F.col("n").asc(), F.col("id").asc()])
    assert rows(out, "k", "id") == [("k1", "b"), ("k2", "e"), ("k3", "f")]


def test_latest_per_key_is_idempotent(spark):
    data = [(random.choice("abc"), random.choice([None, "2024-01-01", "2024-02-01"]), i) for i in range(200)]
    df = spark.createDataFrame(data, "k string, d string, i int")
    order = [F.col("d").desc_nulls_first(), F.col("i").asc()]
    once = latest_per_key(df, ["k"], order)
    assert rows(latest_per_key(once, ["k"], order)) == rows(once)


def _window_rank(df, desc=True, nulls_first=True):
    o = F.col("v").desc_nulls_first() if desc and nulls_first else (
        F.col("v").desc_nulls_last() if desc else (F.col("v").asc_nulls_first() if nulls_first else F.col("v").asc_nulls_last()))
    return df.withColumn("want", F.rank().over(Window.orderBy(o)))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5), st.floats(-3, 3, allow_nan=False, width=32)), max_size=40),
       st.booleans(), st.booleans(), st.integers(1, 6))
def test_global_rank_equals_window_rank(spark, values, desc, nulls_first, buckets):
    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], "id int, v double")
    got = global_rank(df, F.col("v"), "r", descending=desc, nulls_first=nulls_first, buckets=buckets)
    want = _window_rank(df, desc, nulls_first)
    assert rows(got, "id", "r") == [(i, w) for i, w in rows(want, "id", "want")]


def test_global_rank_all_null_group_ranks_first(spark):
    df = spark.createDataFrame([(1, None), (2, 4.0), (3, None), (4, 5.0)], "id int, v double")
    assert rows(global_rank(df, F.col("v"), "r"), "id", "r") == [(1, 1), (2, 4), (3, 1), (4, 3)]


def test_share_within_and_partition_aggregate_match_windows(spark):
    data = [(random.choice(["b1", "b2", None]), random.choice(["m1", "m2"]), random.randint(1, 9)) for _ in range(60)]
    df = spark.createDataFrame(data, "bank string, month string, n int").withColumn("id", F.monotonically_increasing_id())
    got = share_within(df, ["bank", "month"], "n", "pct", 2)
    w = Window.partitionBy("bank", "month")
    want = df.withColumn("pct", F.round((F.col("n") * 100.0 / F.sum("n").over(w)).cast("decimal(18,6)"), 2).cast("double"))
    assert rows(got, "id", "pct") == rows(want, "id", "pct")
    pa = partition_aggregate(df, ["bank"], {"total": F.sum("n"), "cnt": F.count(F.lit(1))})
    wb = Window.partitionBy("bank")
    want2 = df.withColumn("total", F.sum("n").over(wb)).withColumn("cnt", F.count(F.lit(1)).over(wb))
    assert rows(pa, "id", "total", "cnt") == rows(want2, "id", "total", "cnt")


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, c long")
    assert rows(share_of_total(df, "c", "p", 1), "k", "p") == [("a", 33.3), ("b", 66.7)]


def test_column_checks(spark):
    parent = spark.createDataFrame([("x",), ("y",)], "name string")
    child = spark.createDataFrame([("k1", "x"), ("k1", "z"), (None, None), ("k2", "y")], "key string, bank string")
    assert rows(checks.dq_unique(child, "c", "key"), "failures") == [(1,)]
    assert rows(checks.dq_not_null(child, "c", "key"), "failures") == [(1,)]
    assert rows(checks.dq_relationships(child, "c", "bank", parent, "name"), "failures") == [(1,)]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["b1", "b2", "b3"]), st.sampled_from(["m1", "m2"]), st.integers(1, 50)),
                min_size=1, max_size=30))
def test_shares_sum_to_hundred_per_partition(spark, data):
    df = spark.createDataFrame(data, "bank string, month string, n int")
    got = share_within(df, ["bank", "month"], "n", "pct", 6)
    sums = got.groupBy("bank", "month").agg(F.sum("pct").alias("s")).collect()
    assert all(abs(r.s - 100.0) < 1e-3 for r in sums)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["a", "a-b", "b", "-"])),
                          st.one_of(st.none(), st.sampled_from(["b", "", "c-", "_dbt_utils_surrogate_key_null_"]))),
                min_size=2, max_size=12))
def test_surrogate_key_equality_follows_tuple_equality_on_distinct_text(spark, data):
    from avisflow.functions.keys import surrogate_key
    df = spark.createDataFrame(data, "x string, y string").select("x", "y", surrogate_key("x", "y").alias("k"))
    keys = {}
    for r in df.collect():
        keys.setdefault(r.k, set()).add((r.x, r.y))
    # one key per tuple, except the documented ambiguities of the convention ('-' inside values,
    # a value equal to the null placeholder)
    for k, tuples in keys.items():
        if len(tuples) > 1:
            assert all("-" in (x or "") + (y or "") or "_dbt_utils_surrogate_key_null_" in (y or "") or x is None or y is None
                       for x, y in tuples)


def test_dense_row_number_matches_global_window_with_a_hot_key(spark):
    from avisflow.operators.rownum import dense_row_number
    data = [("hot" if i % 3 else f"k{i % 7}", i) for i in range(300)]
    df = spark.createDataFrame(data, "k string, u int")
    order = [F.col("k").asc_nulls_last(), F.col("u").asc_nulls_last()]
    got = dense_row_number(df, order, "rid", partitions=5)
    want = df.withColumn("rid", F.row_number().over(Window.orderBy(*order)))
    assert rows(got, "u", "rid") == rows(want, "u", "rid")


def test_global_ranks_mixed_key_types_match_windows(spark):
    from avisflow.operators.ranking import global_ranks
    data = [(i, None if i % 7 == 0 else round(random.uniform(1, 5), 6), random.randint(1, 6)) for i in range(80)]
    df = (spark.createDataFrame(data, "id int, avg double, n long")
               .withColumn("avg", F.col("avg").cast("decimal(18,6)")))
    got = global_ranks(df, {"r_avg": F.col("avg"), "r_n": F.col("n")}, buckets=7)
    want = (df.withColumn("r_avg", F.rank().over(Window.orderBy(F.col("avg").desc_nulls_first())))
              .withColumn("r_n", F.rank().over(Window.orderBy(F.col("n").desc_nulls_first()))))
    assert rows(got, "id", "r_avg", "r_n") == rows(want, "id", "r_avg", "r_n")


def test_the_size_of_a_written_table_decides_on_its_broadcast(spark):
    from avisflow.operators.joins import broadcast_if_small, estimated_size_bytes
    from avisflow.session import materialized_table
    t = materialized_table(spark.range(1000), "sized")
    size = estimated_size_bytes(t)
    assert size is not None and 0 < size < 100_000
    assert broadcast_if_small(t, size - 1) is t and broadcast_if_small(t, size) is not t
