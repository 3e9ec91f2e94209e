"""Extraction, tokenisation, secret scans, classifier, language model against brute force."""

import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from llm_helpers import lower, odd_docs, words
from hypothesis import given, settings
from hypothesis import strategies as st

from avisflow.llm import automaton, html_text, lm, piece_bpe, quality, queries, secret_scan

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


# -- html ------------------------------------------------------------------------
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><div id="header"><a href=/>Home</a></div>
<header><h2>Site</h2></header><nav><ul><li><a href=a>Menu</a></li></ul></nav><div class="ad">Buy this wonderful thing right now please</div>
<div class="content"><h1>Title &amp; more</h1><p>First   para with a <a href=x>link</a> and&nbsp;enough words to matter here.<p>Second &eacute; para
<br>after a break, long enough to be a block too.<ul><li>one item<li>two item</ul><table><tr><td>a<td>b<tr><td>c<td>d</table>
<div class="share">tweet it</div><section id="comments"><p>Great post! I liked it very much indeed, thank you so much</p></section></div>
<aside><p>Side text that goes on for quite a while as well</p></aside><form><p>Sign up now for free</p></form>
<div class="cookie-notice">We use cookies</div><footer>foot &copy;</footer><script>if(a<b){"</p>"}</script></body></html>"""


def test_page_with_everything():
    assert html_text.main_text(PAGE) == "\n\n".join([
        "Title & more", "First para with a link and enough words to matter here.",
        "Second é para after a break, long enough to be a block too.", "one item", "two item", "a b", "c d"])


@pytest.mark.parametrize("page,text", [(None, ""), ("", ""), ("<p>", ""), ("plain & simple", "plain & simple"), ("<div>" * 30000 + "x", "x"),
                                       ("<nav>menu</nav>", ""), ("a < b and <b>c</b>", "a < b and c"), ("<p>one<p>two", "one\n\ntwo"),
                                       ("<article><p>x</article></b></p>y", "x")])
def test_odd_pages(page, text):
    assert html_text.main_text(page) == text


def test_two_sections_of_an_article_both_stay():
    body = "".join(f"<section>{''.join(f'<p>Paragraph {i} {j} with some more words in it.</p>' for j in range(n))}</section>" for i, n in ((1, 5), (2, 3)))
    assert html_text.main_text(f"<body><article>{body}</article><footer>f</footer></body>").count("Paragraph") == 8


BODY = "".join(f"<p>Paragraph {i} of the story, with a few more words in it.</p>" for i in range(6))
SIDE = '<div class="left-sidebar"><p>Side words</p></div><section id="comments"><article class="comment"><p>Well said</p></article></section>'


@pytest.mark.parametrize("start,end", [(f"<div class='{c}'>", "</div>") for c in (
    "content has-sidebar", "page no-sidebar", "content-sidebar-wrap", "post nav-open", "entry comments-closed", "modal", "page widget")]
    + [("<form action=x>", "</form>"), ("<div id=overlay><form>", "</form></div>")])
def test_wrappers_do_not_lose_the_text(start, end):
    want = [f"Paragraph {i} of the story, with a few more words in it." for i in range(6)]
    for body in (f"<article>{BODY}</article>", BODY):
        for side in ("", SIDE):
            got = html_text.main_text(f"<body>{start}{body}{side}{end}<footer>f</footer></body>")
            assert got.split("\n\n") == want


def test_a_menu_is_not_most_of_the_text():
    menu = "".join(f"<li><a href=/{i}>An entry of the menu number {i}</a></li>" for i in range(90))
    assert "menu" not in html_text.main_text(f"<body><div class=menu><ul>{menu}</ul></div><div>{BODY}</div></body>")


def test_a_small_article_does_not_cut_the_form_around_the_text():
    assert html_text.main_text(f"<body><form>{BODY}</form><article></article></body>").count("Paragraph") == 6


def test_sibling_articles_all_stay():
    page = f"<body><div><article>{BODY}</article><article>{BODY}</article><article>{BODY}</article></div><div><p>Text beside them.</p></div></body>"
    assert html_text.main_text(page).count("Paragraph") == 18 and "beside" not in html_text.main_text(page)


def test_long_comments_stay_cut():
    page = f"<body><div><p>A short story of a few words.</p></div><section class=comments>{BODY}</section></body>"
    assert html_text.main_text(page) == "A short story of a few words."
    assert html_text.main_text(f"<body><section class=comments>{BODY}</section></body>").count("Paragraph") == 6


@given(st.text(alphabet="<>/apdivbr \"'=&;!-", max_size=60))
@settings(max_examples=150, deadline=None)
def test_any_markup_is_read(page):
    assert isinstance(html_text.main_text(page), str)


def test_pages_table(spark):
    import html as h
    rows = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op1_html_text(spark, SF).collect():
        article = re.search(r"<article>(.*?)</article>", rows[r["page_id"]], re.S)[1]
        blocks = [" ".join(h.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])
    odd = spark.createDataFrame([(1, None, None, "x"), (None, "u", "<p>a", "y"), (1, None, None, "x")], "page_id long, url string, html string, text string")
    assert sorted((r["text"] for r in html_text.extract_pages(odd).collect())) == ["", "", "a"]
    assert html_text.extract_pages(odd.limit(0)).count() == 0


# -- tokenisation ----------------------------------------------------------------
@pytest.fixture(scope="module")
def coder():
    return piece_bpe.Encoder(piece_bpe.Vocabulary(MODEL))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def same(coder, library, texts):
    for t, ids in zip(texts, coder.encode(texts)):
        want = [library.bos_id(), *library.encode(t), library.eos_id()]
        assert ids.tolist() == want, t[:80]
        assert coder.decode(ids) == library.decode(want), t[:80]


def test_pieces_of_odd_texts(coder, library):
    same(coder, library, ["", " ", "  ", " a ", "  a  b  ", "\n", "▁", "a▁b", "▁▁a ▁", "a" * 3000, "日本語 漢字", "🙂🙃 x🙂", "\0a\0", "<s> </s> <0x41> <unk>",
                          " " * 100, "=-" * 500, "abab" * 77, "﻿ab", "x y", "word " * 3000])


@given(st.lists(st.text(alphabet=st.sampled_from(" abcdeAB▁\n=-_01éü日🙂\t"), max_size=80), min_size=1, max_size=6))
@settings(max_examples=150, deadline=None)
def test_pieces_equal_the_library(coder, library, texts):
    same(coder, library, texts)


@given(st.text(max_size=60))
@settings(max_examples=150, deadline=None)
def test_pieces_of_any_characters(coder, library, text):
    if not any(0xD800 <= ord(c) < 0xE000 for c in text):
        same(coder, library, [text])


def test_pieces_of_the_table(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op4_piece_bpe(spark, SF).collect():
        ids = [library.bos_id(), *library.encode(docs[r["doc_id"]]), library.eos_id()]
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_pieces_keep_other_columns(spark):
    out = piece_bpe.encode_decode(odd_docs(spark), MODEL)
    assert out.count() == odd_docs(spark).count() and "block" in out.columns
    assert {bytes(r["ids"]) for r in out.where("doc_id = 4 or doc_id = 5").collect()} == {np.array([1, 2], "<u4").tobytes()}
    assert piece_bpe.encode_decode(odd_docs(spark).limit(0), MODEL).count() == 0


# -- secrets ---------------------------------------------------------------------
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6 and m[0].isascii()]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(found)]


@pytest.fixture(scope="module")
def scanner():
    return secret_scan.Scanner()


PARTS = ["token", "secret", "password", "passwd", "api_key", "apiKey", "APIKEY", ":", "=", " ", "  ", '"', "'", "abc", "abcdef", "é", "\n", "AKIA",
         "ABCD1234", "0123456789abcdef", "deadbeefdeadbeef", "ABCDEFGH12345678", ".", "_", "tok", "x", "ghp_", "🙂"]


@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=14).map("".join), min_size=1, max_size=8))
@settings(max_examples=300, deadline=None)
def test_base_spans(scanner, texts):
    for t, found in zip(texts, scanner.scan([t.encode() for t in texts])):
        assert [s for s in found if s[0] in ("assign", "access", "hex")] == base_spans(t)


def test_own_rules_and_long_texts(scanner):
    text = "é" * 70000 + " ghp_" + "a1B2" * 10 + " x\n-----BEGIN RSA PRIVATE KEY-----\n" + "deadbeef" * 3000
    assert scanner.scan([text.encode()])[0] == [("github", 70001, 70045), ("pem", 70048, 70079), ("hex", 70080, 70080 + 24000)]


@pytest.mark.parametrize("pattern", ["a(b|cd)*e?", "[^a-c]{2,3}x+", "(ab|a)(c|bcd)", r"\x20?a{2}|b+"])
def test_automata_against_re(pattern):
    machine = automaton.compile_rule(pattern)
    rng = np.random.default_rng(0)
    for _ in range(500):
        text = "".join(rng.choice(list("abcdex "), rng.integers(0, 8)))
        lengths = [n for n in range(len(text) + 1) if re.fullmatch(f"(?:{pattern})", text[:n])]
        found = secret_scan._longest(machine, text.encode(), 0, len(text), 1)
        assert found == max([n for n in lengths if n], default=-1)


def test_secrets_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op5_secret_scan(spark, SF).collect():
        want = base_spans(docs[r["doc_id"]])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        kinds = Counter(k for k, _, _ in want)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert set(line.split(",")) <= set(r["spans"].split(",")) | {""}


def test_secrets_odd_cases(spark):
    got = secret_scan.scan_secrets(odd_docs(spark)).collect()
    assert len(got) == odd_docs(spark).count()
    assert [(s["kind"], s["start"], s["end"]) for r in got if r["doc_id"] == 17 for s in r["spans"]] == [("assign", 0, 14)]
    assert secret_scan.scan_secrets(odd_docs(spark).limit(0)).count() == 0


# -- classifier ------------------------------------------------------------------
def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op6_quality(spark, sf).collect() if r["doc_id"] in labels]
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.95
    good, bad = ([r["score"] for r in held if labels[r["doc_id"]] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97  # ranking
    score, y = np.array([r["score"] for r in held]), np.array([labels[r["doc_id"]] for r in held])
    assert abs(score.mean() - y.mean()) < 0.04  # calibrated on the whole


def test_quality_odd_cases(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1), (16, 7), (99, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), labels.limit(0))).count() == 0
    with pytest.raises(ValueError):
        quality.score(docs.withColumnRenamed("score_", "score"), model)


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - quality, quality) as quality")
    a, b = (sorted(tuple(r) for r in quality.score(docs, quality.fit(docs, x)).select("doc_id", "score").collect()) for x in (labels, flipped))
    assert a == b


# -- language model --------------------------------------------------------------
def brute_base(rows):
    tokens = [(i, [*words(lower(t)), "\n"]) for i, t, *_ in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in tokens]
    count = Counter(w for (_, ws), h in zip(tokens, held) if not h for w in ws)
    total, kinds = sum(count.values()), len(count)
    return [(i, h, len(ws), sum(count[w] > 0 for w in ws), total, sum(math.log10((count[w] + 1) / (total + kinds + 1)) for w in ws))
            for (i, ws), h in zip(tokens, held)]


def close(got, want):
    got = sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6)))
    want = sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6)))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)


@pytest.mark.parametrize("share", [1_000_000, 40])
def test_base_scores(spark, share, monkeypatch):
    monkeypatch.setattr(lm, "HOT_SHARE", share)  # few broadcast words: most go through the join
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = lm.score_texts(docs).collect()
    close([tuple(r) for r in got], brute_base(rows))
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)  # the model beats the base on unseen texts


def test_products_beyond_single_precision_are_normalised():
    n = lm.SIZE
    split = lm.Classes(np.full(n, 1 / n))
    size = sum(int(np.prod(shape)) for _, shape in lm.Parameters.shapes(n, split.size))
    scorer = lm.Scorer((4 * np.random.default_rng(0).standard_normal(size)).astype(np.float32), split)
    for one, two in ((3, 5), (lm.END, lm.END), (lm.OTHER, 0)):
        p = scorer.log_probs(np.arange(n), np.full(n, one), np.full(n, two))
        assert abs(np.exp(p).sum() - 1) < 1e-3


def slow_log10(texts, lex, flat, unigram, others, other_kinds, counts):
    """Scores by their definition, a token at a time, in double precision."""
    split = lm.Classes(unigram)
    p, kind = lm.Parameters(flat.astype(np.float64), lex.n, split.size), split.kind
    for text in texts:
        total, one, two = 0.0, lm.END, lm.END
        for w in [*words(lower(text)), None]:
            at = lex.index.get((w or "").encode(), -1)
            place = lm.END if w is None else int(lex.model[at])
            h = p.context[one] * p.weights[0] + p.context[two] * p.weights[1]
            z = np.exp(p.class_output @ h + p.class_bias)
            chance = z[kind[place]] / z.sum()
            if kind[place] >= lm.FRONT + 2:
                inside = [i for i in np.flatnonzero(kind == kind[place])]
                z = np.exp(p.output[inside] @ h + p.bias[inside])
                chance *= z[inside.index(place)] / z.sum()
            if place == lm.OTHER:
                chance *= (counts.get(w, 0) + 1) / (others + other_kinds + 1)
            total += np.log10(chance)
            one, two = place, one
        yield total


def test_score_equals_the_slow_form(spark, monkeypatch):
    kept, train = {}, lm._train

    def caught(texts, lexicon, unigram):
        kept.update(lex=lexicon.value, unigram=unigram, flat=train(texts, lexicon, unigram))
        return kept["flat"]

    monkeypatch.setattr(lm, "_train", caught)
    monkeypatch.setattr(lm, "FAN", 2)
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(6)
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = {r["doc_id"]: r["score"] for r in lm.score_texts(docs).collect()}
    counts = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in words(lower(t)))
    own = {w for w in counts if kept["lex"].model[kept["lex"].index.get(w.encode(), -1)] != lm.OTHER}
    others = sum(c for w, c in counts.items() if w not in own)
    short = [(i, t) for i, t in rows if len(t or "") < 900][:25]
    for (i, _), want in zip(short, slow_log10([t for _, t in short], kept["lex"], kept["flat"], kept["unigram"], others, len(counts) - len(own), counts)):
        assert abs(got[i] - want) < 1e-3 * max(1, abs(want))


def test_contexts_stop_at_text_ends():
    word, one, two = lm._contexts([np.array([1, 2, 3]), np.array([], int), np.array([4])])
    e = lm.END
    assert word.tolist() == [1, 2, 3, e, e, 4, e] and one.tolist() == [e, 1, 2, 3, e, e, 4] and two.tolist() == [e, e, 1, 2, e, e, e]


def test_lm_odd_cases(spark):
    from llm_helpers import ODD_TEXTS
    close([tuple(r) for r in lm.score_texts(odd_docs(spark)).collect()], brute_base(ODD_TEXTS))
    assert lm.score_texts(odd_docs(spark).limit(0)).count() == 0
    untrained = odd_docs(spark, [(i, "only held out", "s") for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2])
    assert {(r["train_tokens"], r["base_score"]) for r in lm.score_texts(untrained).collect()} == {(0, 0.0)}


def test_vocabulary_grows_with_the_training_words():
    lex = lm.Lexicon([b"w%d" % i for i in range(5000)], list(range(9000, 4000, -1)))
    places = lex.model[lex.look_up([b"w%d" % i for i in range(5000)])]
    assert len(set(places.tolist())) == 5000 and not {lm.OTHER, lm.END} & set(places.tolist())
    assert lex.model[lex.look_up([b"unseen"])].tolist() == [lm.OTHER]
    # words far below the first thousand, each followed by the next one: context tells them apart
    rng = np.random.default_rng(0)
    texts = [2000 + (s + np.arange(100)) % 300 for s in rng.integers(0, 300, 300)]
    word, one, two = lm._contexts(texts)
    unigram = np.bincount(word, minlength=lex.n) + 1e-3
    unigram /= unigram.sum()
    trainer = lm.Trainer(lm.Parameters.start(unigram), unigram)
    for _ in range(30):
        trainer.fit(word, one, two)
    learned = lm.Scorer(trainer.flat, lm.Classes(unigram)).log_probs(word, one, two)
    assert learned.mean() > np.log(unigram[word]).mean() + 1


def test_scores_are_normalised_over_classes():
    n = 5000
    rng = np.random.default_rng(0)
    split = lm.Classes(1 / np.arange(1, n + 1))
    size = sum(int(np.prod(shape)) for _, shape in lm.Parameters.shapes(n, split.size))
    scorer = lm.Scorer((0.5 * rng.standard_normal(size)).astype(np.float32), split)
    for one, two in ((3, 4999), (lm.END, lm.END), (lm.OTHER, 2000)):
        p = scorer.log_probs(np.arange(n), np.full(n, one), np.full(n, two))
        assert abs(np.exp(p).sum() - 1) < 1e-3
    kind = split.kind
    for k in range(lm.FRONT + 2, kind.max() + 1):
        inside = np.flatnonzero(kind == k)
        assert set(inside) == set(range(n)[split.members(k)]) - {lm.OTHER, lm.END}


def test_words_are_split_as_bytes_are():
    texts = [None, "", " ", "a", " B  a\tA\x0b\x0c\r\nb ", "\x1cx\x85y\xa0z \u2003 \u0130", "a\x00 \x00", "Stra\u00dfe \u00c9 I\n"]
    for kind in (pa.string(), pa.large_string()):
        at, held, sizes = lm._words(pa.array(["cut off", *texts], kind).slice(1))
        got = [held[i].as_py() for i in at.tolist()]
        want = [(t or "").encode().lower().split() for t in texts]
        assert sizes.tolist() == [len(w) for w in want] and got == sum(want, [])


@pytest.mark.parametrize("index", [[7], [3] * 50, [1, 5, 1, 1, 2, 5], np.random.default_rng(0).zipf(1.3, 5000) % 900])
def test_sums_of_rows_that_share_an_index(index):
    index = np.array(index)
    rows = np.random.default_rng(1).standard_normal((len(index), 3)).astype(np.float32)
    groups = lm._Groups(index)
    assert sorted(groups.at.tolist()) == sorted(set(index.tolist()))
    for i, total, one in zip(groups.at, groups.sums(rows), groups.sums(rows[:, 0].copy())):
        assert np.allclose(total, rows[index == i].sum(0), atol=1e-3) and abs(one - rows[index == i, 0].sum()) < 1e-3


def test_a_training_step_equals_the_plain_form():
    rng = np.random.default_rng(3)
    n, m = 3000, 500
    unigram = 1 / np.arange(1, n + 1)
    unigram /= unigram.sum()
    word, one, two = (rng.choice(n, m, p=unigram) for _ in range(3))
    word[:4], weight = [lm.OTHER, lm.END, 5, 2000], rng.integers(1, 9, m).astype(np.float32)
    trainer = lm.Trainer(lm.Parameters.start(unigram), unigram)
    trainer.flat += rng.normal(0, 0.1, len(trainer.flat)).astype(np.float32)
    p = {k: v.astype(np.float64) for k, v in trainer.p.tables.items()}
    draws = np.random.default_rng(lm.SEED)
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    h = p["context"][one] * p["weights"][0] + p["context"][two] * p["weights"][1]
    back, kind = np.zeros_like(h), trainer.kind[word]
    for level, rows, target in ((trainer.top, np.arange(m), kind), (trainer.inner, np.flatnonzero(kind >= lm.FRONT + 2), word)):
        noise = level.draw(draws)
        for i in rows:
            for j, hit in [(target[i], True), *((j, False) for j in noise)]:
                z = h[i] @ p[level.output][j] + p[level.bias][j] - level.noise_log[j]
                g = weight[i] * (hit - 1 / (1 + np.exp(-z)))
                grad[level.output][j] += g * h[i]
                grad[level.bias][j] += g
                back[i] += g * p[level.output][j]
    for k, ids in enumerate((one, two)):
        np.add.at(grad["context"], ids, back * p["weights"][k])
        grad["weights"][k] = (back * p["context"][ids]).sum(0)
    trainer.step(word, one, two, weight)
    for name, g in grad.items():
        g = g / weight.sum()
        assert np.allclose(trainer.p.tables[name], p[name] + lm.RATE * g / np.sqrt(1e-8 + g * g), atol=2e-4), name


def test_scoring_holds_no_vector_for_each_token():
    n, m = 5000, 200_000
    split = lm.Classes(1 / np.arange(1, n + 1))
    size = sum(int(np.prod(shape)) for _, shape in lm.Parameters.shapes(n, split.size))
    scorer = lm.Scorer(np.random.default_rng(0).standard_normal(size).astype(np.float32), split)
    word, one, two = (np.random.default_rng(k).integers(0, n, m) for k in range(3))
    tracemalloc.start()
    try:
        scorer.log_probs(word, one, two)
        assert tracemalloc.get_traced_memory()[1] < 200 * m
    finally:
        tracemalloc.stop()
