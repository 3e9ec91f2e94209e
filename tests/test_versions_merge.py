"""Sinks that survive retries and failures; dimensions that keep their audit times."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from support import SF_SMALL, rows

from avisflow.operators.merge import merge_dimension
from avisflow.plans import build
from avisflow.sources.sinks import append_batch, replace_table, write_reviews_csv
from avisflow.sources.versions import current, read_current, remove_old, replace_version, versions
from avisflow.streaming.ingest import ingest_batches
from test_sources import _batch

T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x int")


def test_a_failed_replace_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        current(spark, path)
    replace_version(numbers(spark, 1, 2), path)
    broken = spark.range(100).repartition(4).select(
        F.when(F.col("id") == 77, F.raise_error(F.lit("half-way")).cast("int")).otherwise(F.col("id").cast("int")).alias("x"))
    with pytest.raises(Exception, match="half-way"):
        replace_version(broken, path)
    assert rows(read_current(spark, path)) == [(1,), (2,)]
    replace_version(read_current(spark, path).select((F.col("x") * 10).alias("x")), path)  # from itself
    assert rows(read_current(spark, path)) == [(10,), (20,)]


def test_old_versions_go_later_and_readers_keep_theirs(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_version(numbers(spark, 1), path)
    reader = read_current(spark, path)
    replace_version(numbers(spark, 2), path)
    replace_version(numbers(spark), path)  # empty tables are versions too
    assert rows(reader) == [(1,)] and read_current(spark, path).count() == 0 and len(versions(spark, path)) == 3
    (tmp_path / "t" / "data-000000000002-left").mkdir()  # of a write that never committed
    gone = remove_old(spark, path)
    assert len(gone) == 3 and len(versions(spark, path)) == 1 and read_current(spark, path).columns == ["x"]
    with pytest.raises(ValueError):
        remove_old(spark, path, keep=0)
    for v in (5, 6, 7):
        folder = replace_table(numbers(spark, v), path)
    assert rows(spark.read.parquet(folder)) == [(7,)] and len(versions(spark, path)) == 2


def test_a_batch_sent_twice_is_stored_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    day = dt.date(2024, 5, 1)
    for _ in range(2):
        append_batch(_batch(spark, 0, 4), path, day, "a")
    append_batch(_batch(spark, 0, 4), path, day, "b")  # the same rows in another batch are another delivery
    append_batch(_batch(spark, 4, 3), path, dt.date(2024, 5, 2), "a")
    assert spark.read.parquet(path).count() == 11


def test_a_stream_without_its_checkpoint_adds_nothing(spark, tmp_path):
    src, dst = str(tmp_path / "in"), str(tmp_path / "raw")
    write_reviews_csv(_batch(spark, 0, 6), src)
    for attempt in range(2):
        ingest_batches(spark, src, dst, str(tmp_path / f"ck{attempt}"), dt.date(2024, 5, 1))
    assert spark.read.parquet(dst).count() == 6


def test_merged_dimension(spark):
    def dim(*values):
        return spark.createDataFrame(values, "k string, name string, n int")

    first = merge_dimension(dim(("a", "A", 1), ("b", None, 2), ("c", "C", 3)), None, "k", T1)
    second = merge_dimension(dim(("a", "A", 1), ("b", None, 5), ("d", "D", 4)), first, "k", T2)
    third = merge_dimension(dim(("a", "A", 1), ("b", None, 5), ("c", "C", 3)).withColumn("new", F.lit(None).cast("string")), second, "k", T3)
    assert rows(second) == [("a", "A", 1, T1, T1), ("b", None, 5, T1, T2), ("c", "C", 3, T1, T1), ("d", "D", 4, T2, T2)]
    assert rows(third) == [("a", "A", 1, None, T1, T1), ("b", None, 5, None, T1, T2), ("c", "C", 3, None, T1, T1), ("d", "D", 4, None, T2, T2)]


def test_a_repeated_build_keeps_raw_rows_and_audit_times(spark, tmp_path):
    out = str(tmp_path / "warehouse")
    day = dt.date(2024, 12, 31)
    before = build.run(spark, SF_SMALL, out_dir=out, ingest_date=day, now=T1)
    raw = spark.read.parquet(before["staging_reviews"]).count()
    after = build.run(spark, SF_SMALL, out_dir=out, ingest_date=day, now=T2)
    assert spark.read.parquet(after["staging_reviews"]).count() == raw
    for name in ("dim_bank", "dim_branch", "dim_location", "dim_sentiment"):
        assert before[name] != after[name]
        times = spark.read.parquet(after[name]).select("created_at", "updated_at").distinct()
        assert rows(times) == [(T1, T1)]
