import pytest
from pyspark.sql import functions as F

from avisflow.sources.reviews_csv import read_checked, read_reviews_csv
from avisflow.sources.sinks import write_reviews_csv
from avisflow.streaming.ingest import ingest_available

STAGING = "bank string, agency string, url string, location string, author string, rating double, " \
          "review_date string, review_text string"


def _batch(spark, start, n):
    return spark.createDataFrame(
        [("B", "A", "u", "L", f"a{i}", float(1 + i % 5), None if i % 2 else "2024-01-01",
          f'  line one "quoted", {i}\nline two  ') for i in range(start, start + n)], STAGING)


def test_csv_roundtrip_keeps_quotes_newlines_spaces_and_nulls(spark, tmp_path):
    b = _batch(spark, 0, 5)
    write_reviews_csv(b, str(tmp_path / "csv"))
    back = read_reviews_csv(spark, str(tmp_path / "csv"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, b.collect()))


def test_rating_sentinel_becomes_null(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text('bank,agency,url,location,author,rating,date,text\n"B","A","u","L","x","Non spécifié","d","t"\n',
                 encoding="utf-8")
    assert read_reviews_csv(spark, str(p)).first().rating is None


def test_stream_ingest_picks_up_only_new_files(spark, tmp_path):
    src, dst, ck = str(tmp_path / "in"), str(tmp_path / "staging"), str(tmp_path / "ck")
    write_reviews_csv(_batch(spark, 0, 4), src + "/day1")
    ingest_available(spark, src + "/*", dst, ck)
    assert spark.read.parquet(dst).count() == 4
    write_reviews_csv(_batch(spark, 10, 3), src + "/day2")
    ingest_available(spark, src + "/*", dst, ck)
    staged = spark.read.parquet(dst)
    assert staged.count() == 7
    assert staged.where(F.col("review_text").startswith("  line one")).count() == 7


HEAD = "bank,agency,url,location,author,rating,date,text\n"


def _write(path, body):
    path.write_text(body, encoding="utf-8")
    return str(path)


def test_broken_rows_are_quarantined_with_their_record(spark, tmp_path):
    body = (HEAD + '"B","A","u","L","x","4","d","good, and ""quoted""\nover two lines"\n'
            + '"B","A","u"\n' + '"B","A","u","L","x","4","d","t","more"\n' + HEAD
            + '"B","A","u","L","x","five","d","t"\n' + '"B","A","u","L","x","Non spécifié","d","t"\n'
            + ',,,,,,,\n')
    kept, bad = read_checked(spark, _write(tmp_path / "raw.csv", body))
    assert sorted((r.bank or "", r.rating or 0.0, r.review_text or "") for r in kept.collect()) == [
        ("", 0.0, ""), ("B", 0.0, "t"), ("B", 4.0, 'good, and "quoted"\nover two lines')]
    assert sorted(map(tuple, bad.collect())) == [
        ("fields", '"B","A","u"'), ("fields", '"B","A","u","L","x","4","d","t","more"'),
        ("header", '"bank","agency","url","location","author","rating","date","text"'),
        ("rating", '"B","A","u","L","x","five","d","t"')]


def test_missing_and_empty_review_files(spark, tmp_path, caplog):
    with pytest.raises(FileNotFoundError):
        read_checked(spark, str(tmp_path / "none.csv"))
    for name, body in (("header.csv", HEAD), ("empty.csv", "")):
        with caplog.at_level("WARNING"):
            caplog.clear()
            kept, bad = read_checked(spark, _write(tmp_path / name, body))
        assert kept.count() == bad.count() == 0
        assert "no review" in caplog.text


def test_good_rows_are_kept_whole(spark, tmp_path):
    b = _batch(spark, 0, 50)
    write_reviews_csv(b, str(tmp_path / "csv"))
    kept, bad = read_checked(spark, str(tmp_path / "csv"))
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, b.collect())) and bad.isEmpty()
