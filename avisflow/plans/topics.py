"""NLP-7..13: topic extraction per language.

* ``topic_documents``: the filtered, projected scan (text_length > 20), preprocessing to the
  LDA text (built-in regex + higher-order functions) and the language gate (>= 10 rows and
  >= 10 non-empty documents, 'unknown' skipped).
* ``tfidf_terms``: 1-2-gram document/term frequencies with min_df / max_df / top-100 by
  corpus frequency, idf = ln((1+n)/(1+df)) + 1; words first, then the pairs that can still lead;
  top-k per language uses row_number <= k, which Spark limits map-side before the shuffle.
* ``keyword_topics``: the deterministic topic of every review, by the category words its text holds.
* ``lda_topics`` / ``topic_assignment``: per language counts of the vocabulary -> idf scaling ->
  L2 norm -> LDA k=5 (Spark ML's online optimizer, step for step, on batches of documents), then
  category matching and the per-review dominant topic.
* ``category_scores``: keyword -> category substring match, computed per topic row with
  higher-order functions (no join with the category table at all).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Window, functions as F

from avisflow.functions.numeric import pg_round
from avisflow.functions.stopwords import all_stopwords
from avisflow.operators import online_lda
from avisflow.operators.terms import known_terms, pair_counts, word_counts
from avisflow.session import checkpointed, materialized_table

# ---------------------------------------------------------------------------
# Topic parameters and the reference's keyword categories, in listed order.
MIN_TEXT_LENGTH = 20
MIN_DOCUMENTS = 10
N_TOPICS = 5
MAX_ITER = 100
SEED = 42
MAX_FEATURES = 100
MIN_DF = 2
MAX_DF = 0.8
TOP_WORDS = 10
KEYWORDS_SHOWN = 5
CATEGORIES = [
    ("service_client", ["service", "personnel", "accueil", "staff", "équipe", "conseiller"]),
    ("attente_rapidite", ["attente", "rapide", "lent", "temps", "queue", "file"]),
    ("frais_tarifs", ["frais", "cher", "prix", "tarif", "coût", "gratuit"]),
    ("digital_technologie", ["application", "app", "site", "internet", "digital", "technologie"]),
    ("localisation_acces", ["parking", "accès", "location", "proche", "loin", "centre"]),
]
DEFAULT_CATEGORY = "autre"
# Deterministic keyword table for the checked category query: vocabulary ranks in groups of ten.
RANK_GROUP = 10
# Words whose pairs are counted alone; more are not brought to the driver.
PAIR_WORDS = 100_000
# ---------------------------------------------------------------------------

NON_WORD = r"[^\p{L}\p{N}_]+"
DIGITS = r"\p{Nd}+"


def _lda_tokens(text: Column) -> Column:
    """STR-6 + length rule: lower, non-word -> space, drop digits, collapse spaces, split,
    keep tokens longer than two characters."""
    x = F.regexp_replace(F.lower(text), NON_WORD, " ")
    x = F.trim(F.regexp_replace(F.regexp_replace(x, DIGITS, ""), " +", " "))
    return F.filter(F.split(x, " "), lambda t: F.length(t) > 2)


def with_lda_text(df: DataFrame, text_col: str, out: str = "lda_text") -> DataFrame:
    """STR-7: tokens without stop words, rejoined. Stop words are removed by Spark ML's
    StopWordsRemover (a hash-set lookup per token, JVM-side)."""
    from pyspark.ml.feature import StopWordsRemover

    remover = StopWordsRemover(inputCol="__tok", outputCol="__kept", stopWords=list(all_stopwords()),
                               caseSensitive=True)
    return (remover.transform(df.withColumn("__tok", _lda_tokens(F.col(text_col))))
                   .withColumn(out, F.array_join("__kept", " ")).drop("__tok", "__kept"))


def _candidates(stg: DataFrame) -> DataFrame:
    """SRC-3: the projected, filtered scan of the topic job ('unknown' skipped)."""
    return (stg.where((F.col("text_length") > MIN_TEXT_LENGTH) & (F.col("detected_language") != "unknown"))
               .select("review_id", F.col("detected_language").alias("language"), "clean_text"))


def topic_documents(enriched: DataFrame) -> DataFrame:
    """SRC-3 + NLP-7 + FLT-7: (review_id, language, lda_text, n_documents) of eligible
    languages, non-empty documents only. The processed texts are written once and read by the gate
    and by the documents."""
    docs = materialized_table(with_lda_text(_candidates(enriched), "clean_text").drop("clean_text"), "topic_texts")
    gate = language_gate_from(docs).where("eligible").select("language", "n_documents")
    return docs.where(F.col("lda_text") != "").join(F.broadcast(gate), "language")  # at most three languages


def language_gate_from(docs: DataFrame) -> DataFrame:
    return (docs.groupBy("language")
                .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("lda_text") != "").alias("n_documents"))
                .withColumn("eligible", (F.col("n_rows") >= MIN_DOCUMENTS) & (F.col("n_documents") >= MIN_DOCUMENTS)))


def language_gate(enriched: DataFrame) -> DataFrame:
    """AGG-16 + FLT-7: languages present (besides 'unknown') and whether topics are fitted."""
    return language_gate_from(with_lda_text(_candidates(enriched), "clean_text"))


def tfidf_terms(stg: DataFrame) -> DataFrame:
    """NLP-8 from staged reviews; the processed texts are written once and read per count."""
    return vocabulary_of(materialized_table(with_lda_text(_candidates(stg), "clean_text").drop("clean_text"), "topic_texts"))


def vocabulary_of(docs: DataFrame) -> DataFrame:
    """The vocabulary of processed texts (language, lda_text), gate included.

    Words are counted first. A word pair occurs in no more places and texts than either of its words,
    so pairs are then counted only among words that are in MIN_DF texts and occur as often as the last
    of the MAX_FEATURES leading words: no other pair can lead. Should that be more than PAIR_WORDS
    words (many tie), all pairs are counted instead; the result is the same."""
    gate = language_gate_from(docs).where("eligible").select("language", "n_documents")
    words = materialized_table(word_counts(docs, "language", "lda_text"), "topic_words")
    w = Window.partitionBy("language").orderBy(F.col("tf").desc(), F.col("term").asc())

    def leading(counted):
        able = (counted.join(F.broadcast(gate), "language")  # at most three languages
                       .where((F.col("df") >= MIN_DF) & (F.col("df") <= F.col("n_documents") * F.lit(MAX_DF))))
        return able.withColumn("term_rank", F.row_number().over(w)).where(F.col("term_rank") <= MAX_FEATURES)

    last = leading(words).where(F.col("term_rank") == MAX_FEATURES).select("language", F.col("tf").alias("least"))
    able = (words.join(F.broadcast(gate.select("language")), "language").join(F.broadcast(last), "language", "left")
                 .where((F.col("df") >= MIN_DF) & (F.col("tf") >= F.coalesce("least", F.lit(0)))).select("language", "term"))
    among: dict | None = {}
    for language, term in able.limit(PAIR_WORDS + 1).collect():
        among.setdefault(language, set()).add(term)
    if sum(map(len, among.values())) > PAIR_WORDS:
        among = None
    both = words.unionByName(pair_counts(docs, "language", "lda_text", among))
    idf = F.log((F.lit(1.0) + F.col("n_documents")) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return leading(both).select("language", "term", "df", "tf", pg_round(idf, 6).alias("idf"), "term_rank")


def category_scores(topics: DataFrame, keywords_col: str = "keywords") -> DataFrame:
    """NLP-12 / JOI-9 / TOP-4: per topic, the number of keywords containing a word of each
    category; best score wins, first listed category on ties, 'autre' when nothing matches."""
    kw = F.transform(F.col(keywords_col), lambda k: F.lower(k))
    scores = F.array(*[_matching_keywords(kw, words) for _, words in CATEGORIES])
    names = F.array(*[F.lit(c) for c, _ in CATEGORIES])
    df = topics.withColumn("__scores", scores)
    best = F.array_max("__scores")
    first_best = F.array_position(F.col("__scores"), best)
    return (df.withColumn("category", F.when(best > 0, F.element_at(names, first_best.cast("int")))
                                       .otherwise(F.lit(DEFAULT_CATEGORY)))
              .withColumn("category_score", best)
              .withColumn("category_confidence", pg_round(best / F.size(keywords_col), 4))
              .drop("__scores"))


def _matching_keywords(keywords: Column, words: list[str]) -> Column:
    arr = F.array(*[F.lit(w) for w in words])
    return F.size(F.filter(keywords, lambda k: F.exists(arr, lambda w: F.contains(k, w))))


def vocabulary_topics(vocab: DataFrame) -> DataFrame:
    """Deterministic keyword table: the whole vocabulary in rank order, cut into groups of ten."""
    grouped = (vocab.groupBy("language", ((F.col("term_rank") - 1) / RANK_GROUP).cast("int").alias("topic_id"))
                  .agg(F.sort_array(F.collect_list(F.struct("term_rank", "term"))).alias("__k")))
    return grouped.select("language", "topic_id", F.col("__k.term").alias("keywords"))


def topic_category_match(vocab: DataFrame) -> DataFrame:
    return category_scores(vocabulary_topics(vocab)).select(
        "language", "topic_id", "category", "category_score", "category_confidence")


def top_keywords(vocab: DataFrame) -> DataFrame:
    """TOP-2: the first five keywords of each keyword group, joined."""
    return vocabulary_topics(vocab).select("language", "topic_id", joined_keywords("keywords").alias("topic_keywords"))


def joined_keywords(keywords) -> Column:
    return F.array_join(F.slice(keywords, 1, KEYWORDS_SHOWN), ", ")


def argmax(weights: Column) -> Column:
    """TOP-3: place of the largest weight, counted from 0, the first one on ties."""
    return (F.array_position(weights, F.array_max(weights)) - 1).cast("int")


def with_keyword_topic(df: DataFrame, text_col: str = "clean_text") -> DataFrame:
    """Adds dominant_topic, topic_category, topic_keywords, topic_confidence: the category most of
    whose words the text holds (the first listed on ties; 'autre' and confidence 0 if none), its
    words found, and its share of all words found."""
    text = F.col(text_col)
    found = F.array(*[F.filter(F.array(*[F.when(F.contains(text, F.lit(w)), F.lit(w)) for w in words]),
                               lambda w: w.isNotNull()) for _, words in CATEGORIES])
    names = F.array(*[F.lit(c) for c, _ in CATEGORIES])
    df = df.withColumn("__found", found).withColumn("__scores", F.transform("__found", lambda x: F.size(x)))
    best, total = F.array_max("__scores"), F.aggregate("__scores", F.lit(0), lambda a, x: a + x)
    at = argmax(F.col("__scores"))
    any_found = best > 0
    return df.withColumns({
        "dominant_topic": F.when(any_found, at).otherwise(F.lit(len(CATEGORIES))),
        "topic_category": F.when(any_found, F.element_at(names, at + 1)).otherwise(F.lit(DEFAULT_CATEGORY)),
        "topic_keywords": F.when(any_found, joined_keywords(F.element_at("__found", at + 1))).otherwise(F.lit("")),
        "topic_confidence": F.when(any_found, pg_round(best / total, 4)).otherwise(F.lit(0.0)),
    }).drop("__found", "__scores")


def keyword_topics(stg: DataFrame) -> DataFrame:
    """The topic table by category words: every review that the topic job reads."""
    docs = stg.where((F.col("text_length") > MIN_TEXT_LENGTH) & (F.col("detected_language") != "unknown"))
    return topic_table(with_keyword_topic(docs))


def topic_table(df: DataFrame) -> DataFrame:
    return df.select("review_id", "dominant_topic", "topic_category", "topic_keywords", "topic_confidence",
                     F.col("detected_language").alias("language"))


# -- LDA -----------------------------------------------------------------------

def lda_fit(docs: DataFrame, vocab: DataFrame):
    """Fit one LDA per eligible language. Returns (topics, assignments) DataFrames.

    The vocabulary per language is at most MAX_FEATURES terms (a model parameter), so it is
    brought to the driver as the model's dictionary; documents never are."""
    spark = docs.sparkSession
    rows = (vocab.groupBy("language")
                 .agg(F.sort_array(F.collect_list(F.struct("term_rank", "term", "idf"))).alias("v"))
                 .collect())
    # only vocabulary terms reach the count vectors, so only they are kept of the texts
    known = {r["language"]: [x["term"] for x in r["v"]] for r in rows}
    found = known_terms(docs, "review_id", "language", "lda_text", known, "terms")
    corpus = checkpointed(online_lda.count_rows(found, "review_id", "language", "terms", known))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def fit_one(r):
        language = r["language"]
        terms = [x["term"] for x in r["v"]]
        idf = [float(x["idf"]) for x in r["v"]]
        lang_docs = (corpus.where(F.col("language") == language)
                           .repartition(parts, "review_id").sortWithinPartitions("review_id"))
        # iterative fit: read the (small) counts from the shared folder on every pass instead of
        # recomputing their lineage, and survive executor loss without refitting
        counts = checkpointed(online_lda.placed(lang_docs))
        model = online_lda.fit(counts, idf, N_TOPICS, MAX_ITER, SEED)
        leading = [(language, i, [terms[j] for j in words], sum(weights)) for i, (words, weights) in enumerate(model.described(TOP_WORDS))]
        described = (spark.createDataFrame(leading, "language string, topic_id int, keywords array<string>, weight_sum double")
                          .withColumn("weight_sum", pg_round(F.col("weight_sum"), 6)))
        assigned = online_lda.assign(counts, "review_id", idf, model).select(
            "review_id", F.lit(language).alias("language"), F.col("topic").alias("dominant_topic"), F.col("share").alias("topic_confidence"))
        return described, assigned

    # one fit per language (at most three); each fit is a distributed iterative job, and running
    # them from parallel driver threads overlaps their many small per-iteration jobs
    todo = [r for r in sorted(rows, key=lambda x: x["language"]) if r["v"]]
    with ThreadPoolExecutor(max_workers=max(1, len(todo))) as pool:
        fitted = list(pool.map(fit_one, todo))
    topic_frames = [t for t, _ in fitted]
    doc_frames = [d for _, d in fitted]
    if not topic_frames:
        empty_t = spark.createDataFrame([], "language string, topic_id int, keywords array<string>, weight_sum double")
        empty_d = spark.createDataFrame([], "review_id string, language string, dominant_topic int, topic_confidence double")
        return empty_t, empty_d
    topics = topic_frames[0]
    for t in topic_frames[1:]:
        topics = topics.unionByName(t)
    assigned = doc_frames[0]
    for d in doc_frames[1:]:
        assigned = assigned.unionByName(d)
    return category_scores(topics), assigned


def topic_assignment(topics: DataFrame, assigned: DataFrame) -> DataFrame:
    """NLP-13: the topic table (review_id, dominant_topic, topic_category, topic_keywords,
    topic_confidence, language). The topic side has k rows per language and the language
    classifier yields at most three languages, so it is broadcast."""
    t = topics.select("language", F.col("topic_id").alias("dominant_topic"),
                      F.col("category").alias("topic_category"),
                      joined_keywords("keywords").alias("topic_keywords"))
    return (assigned.join(F.broadcast(t), ["language", "dominant_topic"], "left")
                    .select("review_id", "dominant_topic", "topic_category", "topic_keywords",
                            "topic_confidence", "language"))
