"""Null and repeated ids are rows of their own; long odd texts take time in proportion."""

import random
import time
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from llm_helpers import odd_docs

from avisflow.llm import html_text, lines, mixing, piece_bpe, quality

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("rounds", [0, 3, 64])
def test_queue_and_rounds_give_the_library_ids(rounds, monkeypatch):
    monkeypatch.setattr(piece_bpe, "ROUNDS", rounds)
    rng = random.Random(rounds)
    texts = [" " * n for n in (1, 2, 3, 15, 16, 17, 31, 33, 100, 1000, 5001)] + ["a" * n for n in (1, 7, 300)] + ["", "é" * 99, "日本🙂" * 40]
    texts += ["".join(rng.choice("abcdeé  -_▁\t") for _ in range(rng.randrange(400))) for _ in range(60)]
    coder, library = piece_bpe.Encoder(piece_bpe.Vocabulary(MODEL)), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text, ids in zip(texts, coder.encode(texts)):
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True), repr(text[:40])


def test_long_runs_take_time_in_proportion():
    rng = random.Random(0)
    coder, library = piece_bpe.Encoder(piece_bpe.Vocabulary(MODEL)), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [" " * (1 << 20), "".join(rng.choice("etaoinshr") for _ in range(1 << 18)), "x " * 1000 + " " * 200_000 + "y"]
    start = time.perf_counter()
    got = coder.encode(texts)
    assert time.perf_counter() - start < 60
    for text, ids in zip(texts, got):
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_pages_of_unmatched_tags_take_time_in_proportion():
    start = time.perf_counter()
    for page in ("<div>" * 50_000 + "</p></b></i>" * 50_000, "<article>" + "<header>" * 50_000 + "x", "<div>" * 50_000 + "</nav>" * 100_000 + "text",
                 "<article><p>" + "<b>" * 50_000 + "</li>" * 100_000 + "story text"):
        html_text.main_text(page)
    assert time.perf_counter() - start < 60


def test_mix_meets_targets_where_one_id_holds_many_rows(spark):
    for ids in ([7 if i % 2 else i for i in range(1200)], [None if i % 2 else i for i in range(1200)]):
        rows = [(i, f"w{n} " + "a b c d e", "s") for n, i in enumerate(ids)] + [(9999, "x " * 24000, "t")]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
        got = mixing.mix_table(docs, block_words=200).where("source = 's'").collect()
        assert abs(sum(r["taken"] for r in got) - got[0]["target"]) <= 12
        assert mixing.mix(docs, block_words=200).where("source = 's'").count() * 6 == sum(r["taken"] for r in got)


def test_lines_of_null_and_repeated_ids_are_dropped_by_row(spark):
    one, two = "a line that many documents hold, long enough", "another line that many documents hold as well"
    rows = [(i, one) for i in range(6)] + [(i, two) for i in range(10, 16)]
    rows += [(None, f"{one}\nown {i}") for i in range(20)] + [(None, f"{two}\nown")] + [(3, f"{two}\nmore"), (3, "only this")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["kept_text"]) for r in lines.dedup_lines(docs).collect())
    assert got[5, one] == 1 and got[15, two] == 1 and got[3, "more"] == 1 and got[3, "only this"] == 1 and got[3, ""] == 1
    assert all(got[None, f"own {i}"] == 1 for i in range(20)) and got[None, "own"] == 1 and sum(got.values()) == len(rows)


def test_quality_sample_does_not_grow_with_repeated_ids(spark):
    docs = spark.createDataFrame([(7, f"text number {i}") for i in range(500)] + [(8, "x"), (9, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1)] * 30 + [(8, 0)] * 30 + [(9, 0), (9, 1)], "doc_id long, quality int")
    rows = quality.labelled_texts(docs, labels, "doc_id", "text", "quality", 100, quality.held_out, quality.SEED).collect()
    assert len(rows) <= 2 and {r["y"] for r in rows} <= {0, 1}


def test_pipeline_drops_rows_not_ids(spark, tmp_path):
    import corpus_pipeline as cp
    docs = odd_docs(spark, [(1, "same", "a"), (2, "same", "a"), (2, "same", "a"), (None, "same", "a"), (None, "same", "b"), (1, "other", "a"), (None, "alone", "a")])
    exact = cp.exact_dedup(spark, docs, str(tmp_path))
    assert exact.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in exact.collect()) == [(0, "alone"), (1, "other"), (2, "same")]
    near = " ".join(f"w{i}" for i in range(400))
    docs = odd_docs(spark, [(5, near, "a"), (5, near + " x", "a"), (4, near + " y", "a"), (None, near + " z", "a"), (4, "far away from all of them", "a"), (None, "lone words stay here", "b")])
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in cp.simhash_dedup(spark, docs, str(tmp_path)).collect())
    assert kept == [(0, "lone words stay here"), (4, "far away from all of them"), (4, near + " y")]
    assert cp.exact_dedup(spark, docs.where("false"), str(tmp_path)).count() == cp.simhash_dedup(spark, docs.where("false"), str(tmp_path)).count() == 0
