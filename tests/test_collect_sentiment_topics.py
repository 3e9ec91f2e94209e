from pyspark.sql import functions as F

from avisflow.functions import extract as X
from avisflow.plans import collect, sentiment, topics
from support import rows


def test_address_clean_and_guess(spark):
    df = spark.createDataFrame([("Adresse : 12 rue X\n\n  Casablanca \n",), ("Adresse:Bd Y\nRabat",),
                                ("no digit here at all\n12 avenue Hassan II\n",), ("just 12\n",)], "t string")
    out = df.select(X.address_clean("t").alias("c"), X.address_guess("t").alias("g")).collect()
    assert [r.c for r in out] == ["12 rue X, Casablanca", "Bd Y, Rabat", "no digit here at all, 12 avenue Hassan II",
                                  "just 12"]
    assert [r.g for r in out] == ["Adresse : 12 rue X", "Non disponible", "12 avenue Hassan II", "Non disponible"]


def test_rating_parse_labels(spark):
    df = spark.createDataFrame([("4,5 étoiles",), ("Rated 4 stars",), ("Non spécifié",)], "t string")
    out = df.select(X.rating_text("t").alias("txt"), X.rating_value("t").alias("v")).collect()
    assert [(r.txt, r.v) for r in out] == [("4.5", 4.5), ("4", 4.0), ("Non spécifié", None)]


def test_lexicon_scores_negation_and_empty(spark):
    df = spark.createDataFrame([("r1", "very good service"), ("r2", "not good at all"), ("r3", ""),
                                ("r4", "pas mauvais, excellent")], "review_id string, clean_text string")
    out = {r.review_id: r for r in sentiment.sentiment_analysis(df).collect()}
    assert out["r1"].sentiment == "positive" and out["r1"].lexicon_hits == 1
    assert out["r2"].sentiment == "negative"
    assert out["r3"].vader_compound == 0.0 and out["r3"].sentiment == "neutral" and out["r3"].lexicon_hits == 0
    assert out["r4"].vader_compound > 0.0 and out["r4"].lexicon_hits == 2
    assert all(-1.0 <= r.vader_compound <= 1.0 and -1.0 <= r.textblob_polarity <= 1.0 for r in out.values())


def test_keyword_language_fallback_order(spark):
    df = spark.createDataFrame([(1, "Le SERVICE"), (2, "good staff"), (3, "جيد"), (4, "nothing")], "doc_id long, text string")
    assert rows(sentiment.language_keyword_fallback(df), "doc_id", "language") == \
        [(1, "fr"), (2, "en"), (3, "ar"), (4, "unknown")]


def test_lda_text_rules(spark):
    df = spark.createDataFrame([("Très BON service!! 123 agence_x l'accueil est rapide",)], "t string")
    assert topics.with_lda_text(df, "t").first()["lda_text"] == "agence_x accueil est rapide"


def test_category_scores_ties_and_default(spark):
    df = spark.createDataFrame([(0, ["services", "accueil", "attente"]), (1, ["rapide", "frais"]), (2, ["xyz", "abc"])],
                               "topic_id int, keywords array<string>")
    got = rows(topics.category_scores(df), "topic_id", "category", "category_score")
    assert got == [(0, "service_client", 2), (1, "attente_rapidite", 1), (2, "autre", 0)]


def test_tfidf_vocabulary_counts(spark):
    texts = ["alpha beta gamma", "alpha beta", "delta alpha"] + ["alpha"] * 7
    docs = spark.createDataFrame([(f"d{i}", "en", t) for i, t in enumerate(texts)], "review_id string, language string, lda_text string")
    v = {r.term: r for r in topics.vocabulary_of(docs).collect()}
    # alpha is in all 10 documents (> 0.8 * 10): pruned; 'alpha beta' and 'beta' appear twice
    assert set(v) == {"beta", "alpha beta"}
    assert v["beta"].df == 2 and v["beta"].tf == 2


def test_keyword_topic_rules(spark):
    rows_ = [("a", "le personnel et l'accueil, un temps fou"), ("b", "attente et frais"), ("c", "rien de tel"),
             ("d", "service personnel accueil staff équipe conseiller app")]
    out = {r.review_id: r for r in topics.with_keyword_topic(spark.createDataFrame(rows_, "review_id string, clean_text string")).collect()}
    assert (out["a"].dominant_topic, out["a"].topic_category, out["a"].topic_keywords, out["a"].topic_confidence) == \
        (0, "service_client", "personnel, accueil", 0.6667)
    assert (out["b"].dominant_topic, out["b"].topic_category, out["b"].topic_confidence) == (1, "attente_rapidite", 0.5)  # first on ties
    assert (out["c"].dominant_topic, out["c"].topic_category, out["c"].topic_keywords, out["c"].topic_confidence) == (5, "autre", "", 0.0)
    assert out["d"].topic_keywords == "service, personnel, accueil, staff, équipe"  # first five of six


def test_argmax_takes_the_first_largest(spark):
    df = spark.createDataFrame([([0.1, 0.5, 0.5],), ([1.0],), ([0.0, 0.0],)], "w array<double>")
    assert [r[0] for r in df.select(topics.argmax(F.col("w"))).collect()] == [1, 0, 0]


def test_page_fields_fire_and_default(spark):
    page = ('<title> Agence &amp; Cie </title><span class="author">\tAli&nbsp;B. \r\n</span><i aria-label="4,5 étoiles"></i>'
            '<time d=1>hier</time><address>\t1 rue A\r\n  Rabat </address><div class="review-text">Très <b>bon</b>,<br>merci &lt;3</div>')
    pages = spark.createDataFrame([(1, "http://h", page), (2, "http://h", "<p>nothing</p>"),
                                   (3, "http://h", "<article><h1>T</h1><p>one</p>\n<p>two &amp; three</p></article>")],
                                  "page_id long, url string, html string")
    got = {r.page_id: r for r in collect.page_field_extract(pages).collect()}
    assert tuple(got[1])[1:] == ("Agence & Cie", "Ali\u00a0B.", "4.5", "hier", "Très bon , merci <3", "1 rue A, Rabat")
    assert tuple(got[2])[1:] == ("Non spécifié", "Anonyme", "Non spécifié", "Non spécifié", "Non spécifié", "Non disponible")
    assert got[3].text == "T one two & three"  # the whole article, not its first paragraph
    assert {r.page_id for r in collect.review_keep(pages).collect()} == {1, 3}


def test_built_review_pages_decide_every_field(spark):
    pages = collect.with_review_pages(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    f = collect.page_field_extract(pages)
    n = f.count()
    for column, default in (("agency", "Non spécifié"), ("author", "Anonyme"), ("rating", "Non spécifié"), ("date", "Non spécifié"),
                            ("text", "Non spécifié"), ("location", "Non disponible")):
        assert 0 < f.where(F.col(column) == default).count() < n, column
    assert 0 < collect.review_keep(pages).count() < n


def test_address_lines_lose_all_white_space(spark):
    from avisflow.functions import extract
    df = spark.createDataFrame([("Adresse : \t12 rue A\r\n\r\n  Rabat\x0b",)], "t string")
    assert df.select(extract.address_clean("t")).first()[0] == "12 rue A, Rabat"


def test_language_gate_needs_ten_documents(spark):
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    rows_ = []
    for lang, n in (("en", 10), ("fr", 9)):
        for i in range(n):
            text = f"{words[i % 3]} {words[(i + 1) % 3]} {words[3 + i % 3]} common words here"
            rows_.append((f"{lang}{i}", lang, text, len(text)))
    rows_.append(("u0", "unknown", "alpha beta gamma delta epsilon", 30))
    stg = spark.createDataFrame(rows_, "review_id string, detected_language string, clean_text string, text_length int")
    gate = {r.language: r for r in topics.language_gate(stg).collect()}
    assert set(gate) == {"en", "fr"}
    assert gate["en"].eligible and not gate["fr"].eligible and gate["fr"].n_rows == 9
    vocab = topics.tfidf_terms(stg).collect()
    assert vocab and {r.language for r in vocab} == {"en"}
    # 'common', 'words', 'here' are in every document (> 0.8 * 10): pruned by max_df
    assert not {"common", "words", "here"} & {r.term for r in vocab}


LANG_DOCS = [(1, "en", "the cat and the dog"), (2, "fr", "le chat et le chien"), (3, None, "the dog and a cat"),
             (4, None, "zzzqqq"), (5, "en", None), (6, "fr", ""), (7, None, "le chien"), (7, None, "et le chat")]


def test_trigram_languages_do_not_depend_on_how_the_profile_is_joined(spark, monkeypatch):
    docs = spark.createDataFrame(LANG_DOCS, "doc_id long, lang string, text string")
    near = rows(sentiment.language_ngram(docs))
    monkeypatch.setattr(sentiment, "broadcast_if_small", lambda df: df)
    assert near == rows(sentiment.language_ngram(docs))
    found = {(i, p) for i, _, p in near}
    assert {(1, "en"), (2, "fr"), (3, "en"), (5, None), (6, None), (7, "fr")} <= found and len(near) == len(docs.collect())


def test_trigrams_of_a_text_do_not_move_while_the_profile_is_small(spark):
    docs = spark.createDataFrame(LANG_DOCS, "doc_id long, lang string, text string")
    plan = sentiment.language_ngram(docs)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert moved and not any("tri#" in line for line in moved)


def test_trigram_languages_without_labels(spark):
    docs = spark.createDataFrame([(1, None, "some text"), (2, None, None)], "doc_id long, lang string, text string")
    assert rows(sentiment.language_ngram(docs)) == [(1, None, None), (2, None, None)]
    assert sentiment.language_ngram(docs.limit(0)).count() == 0
