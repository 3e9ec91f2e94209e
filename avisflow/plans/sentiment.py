"""NLP-1..6: sentiment and language jobs over whole review texts.

* Lexicon scoring runs per row inside the JVM: tokens -> lexicon lookup (a literal map) ->
  negation flip from the previous token -> sum. No explode, no shuffle, no Python.
* Keyword language fallback: ordered substring lists.
* Character-trigram language model (naive Bayes): trained on labelled texts, applied to every
  text: a profile measured small is broadcast and met where a text is read, a larger one is
  joined with the trigrams counted per text, hot trigrams spread over salts.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from avisflow.functions import classify
from avisflow.functions.lexicon import ALPHA, LEXICON, MAX_WEIGHT, NEGATORS, TOKEN_PATTERN
from avisflow.functions.numeric import pg_round
from avisflow.operators.joins import broadcast_if_small
from avisflow.operators.terms import text_slices
from avisflow.session import materialized_table

# ---------------------------------------------------------------------------
# Keyword fallback lists of the language detector, checked in this order.
FALLBACK_KEYWORDS = [
    ("ar", ["والله", "الله", "جيد", "سيء"]),
    ("fr", ["très", "bon", "mauvais", "service"]),
    ("en", ["good", "bad", "service", "staff"]),
]
SALTS = 16
TRIGRAMS_HELD = 2_000_000
# ---------------------------------------------------------------------------


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)


def _lexicon_map() -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(float(v))) for k, v in LEXICON.items()))


def with_scores(df: DataFrame, text_col: str) -> DataFrame:
    """Adds vader_compound, textblob_polarity, lexicon_hits.

    The negation flip pairs each token with its predecessor (``zip_with`` against the token
    array shifted by one); no lambda refers to a whole array, which could otherwise be inlined
    and re-evaluated for every element."""
    lex = _lexicon_map()
    toks = F.col("__t")
    prev = F.concat(F.array(F.lit(None).cast("string")), F.slice(toks, 1, F.greatest(F.size(toks) - 1, F.lit(0))))
    # membership is a hash lookup; the map is searched key by key, so only words in it reach it
    hits = F.zip_with(toks, prev, lambda t, p: F.when(t.isin(*LEXICON), F.element_at(lex, t)
                                                      * F.when(p.isin(*NEGATORS), F.lit(-1.0)).otherwise(F.lit(1.0))))
    s, n = F.col("__s"), F.col("__n")
    compound = pg_round(s / F.sqrt(s * s + F.lit(ALPHA)), 4)
    polarity = pg_round(F.when(n > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), s / n / F.lit(MAX_WEIGHT))))
                         .otherwise(F.lit(0.0)), 4)
    return (df.withColumn("__t", tokens(F.col(text_col)))
              .withColumn("__w", F.array_compact(hits))
              .withColumns({"__s": F.aggregate("__w", F.lit(0.0), lambda acc, x: acc + x), "__n": F.size("__w")})
              .withColumns({"vader_compound": compound, "textblob_polarity": polarity, "lexicon_hits": n})
              .drop("__t", "__w", "__s", "__n"))


def sentiment_analysis(stg: DataFrame, text_col: str = "clean_text") -> DataFrame:
    """The sentiment table: review_id, sentiment, vader_compound, textblob_polarity, confidence."""
    return sentiment_table(with_scores(stg.select("review_id", text_col), text_col))


def sentiment_table(scored: DataFrame) -> DataFrame:
    return scored.select("review_id", classify.sentiment_label("vader_compound").alias("sentiment"),
                         "vader_compound", "textblob_polarity", F.abs("vader_compound").alias("confidence"),
                         "lexicon_hits")


def language_keyword_fallback(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """NLP-5: case-folded substring lists ar -> fr -> en -> unknown."""
    low = F.lower(F.col(text_col))
    expr = None
    for lang, words in FALLBACK_KEYWORDS:
        cond = None
        for w in words:
            c = low.contains(w)
            cond = c if cond is None else cond | c
        expr = F.when(cond, lang) if expr is None else expr.when(cond, lang)
    return df.select(id_col, expr.otherwise("unknown").alias("language"))


def folded(text: Column) -> Column:
    """The lower-cased text with non-letters folded to one space."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")


def _trigrams(text: str | None) -> np.ndarray:
    """The trigrams of code points at every position, as numbers (21 bits a code point)."""
    c = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return (c[:-2] << 42) | (c[1:-1] << 21) | c[2:]


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    n = np.zeros(len(codes), np.int64)
    np.add.at(n, at, np.concatenate([p[1] for p in parts]))
    return codes, n


def trigram_counts(docs: DataFrame, group: str, text: str) -> DataFrame:
    """(group, tri, c): occurrences per group, added up per task before they move. A task merges what it
    holds of a group once that is TRIGRAMS_HELD numbers, so it holds its distinct trigrams and as many more."""
    def run(batches):
        found: dict = {}
        held: dict = {}
        for batch in batches:
            for part in text_slices(batch):
                texts: dict = {}
                for g, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    texts.setdefault(g, []).append(_trigrams(t))
                for g, codes in texts.items():
                    found.setdefault(g, []).append(np.unique(np.concatenate(codes), return_counts=True))
                    held[g] = held.get(g, 0) + len(found[g][-1][0])
                    if held[g] > TRIGRAMS_HELD:
                        found[g], held[g] = [_summed(found[g])], 0
        for g, parts in found.items():
            codes, n = _summed(parts)
            yield pa.RecordBatch.from_arrays([pa.array([g] * len(codes), pa.string()), pa.array(codes), pa.array(n)], names=[group, "tri", "c"])

    return (docs.select(group, text).mapInArrow(run, f"{group} string, tri long, c long")
                .groupBy(group, "tri").agg(F.sum("c").alias("c")))


def document_trigrams(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, tri, n) of every row's distinct trigrams."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, 64):
                found = [np.unique(_trigrams(t), return_counts=True) for t in part.column(1).to_pylist()]
                rows = pa.array(np.repeat(np.arange(len(found)), [len(c) for c, _ in found]))
                yield pa.RecordBatch.from_arrays([part.column(0).take(rows), pa.array(np.concatenate([c for c, _ in found])),
                                                  pa.array(np.concatenate([n for _, n in found]))], names=[key, "tri", "n"])

    src = docs.select(key, text)
    return src.mapInArrow(run, f"{key} {src.schema[key].dataType.simpleString()}, tri long, n long")


def trigram_sums(docs: DataFrame, key: str, text: str, profile: list, n_groups: int) -> DataFrame:
    """(key, n, s0, s1, ...): per row with a trigram its trigrams and the sums of their weights in a small
    ``profile``, rows of (tri, w0, w1, ...)."""
    listed = sorted(profile, key=lambda r: r["tri"])
    held = docs.sparkSession.sparkContext.broadcast((
        np.array([r["tri"] for r in listed], np.int64),
        np.array([[r[f"w{i}"] or 0.0 for i in range(n_groups)] for r in listed], float).reshape(len(listed), n_groups)))
    names = [key, "n", *(f"s{i}" for i in range(n_groups))]

    def run(batches):
        codes, weights = held.value
        for batch in batches:
            for part in text_slices(batch):
                n, sums = np.zeros(part.num_rows, np.int64), np.zeros((part.num_rows, n_groups))
                for i, t in enumerate(part.column(1).to_pylist()):
                    tris = _trigrams(t)
                    n[i] = len(tris)
                    if len(tris) and len(codes):
                        at = np.minimum(np.searchsorted(codes, tris), len(codes) - 1)
                        sums[i] = weights[at[codes[at] == tris]].sum(0)
                shown = pa.array(np.flatnonzero(n))
                yield pa.RecordBatch.from_arrays([part.column(0).take(shown), pa.array(n[n > 0]),
                                                  *(pa.array(sums[n > 0, i]) for i in range(n_groups))], names=names)

    src = docs.select(key, text)
    return src.mapInArrow(run, f"{key} {src.schema[key].dataType.simpleString()}, n long" + "".join(f", s{i} double" for i in range(n_groups)))


def language_ngram(documents: DataFrame) -> DataFrame:
    """NLP-6: multinomial naive Bayes over character trigrams (Cavnar & Trenkle-style profiles),
    trained on all labelled texts and applied to the whole table.

    score(doc, lang) = sum_t n(doc,t) * ln((c(lang,t) + 1) / (N_lang + V)), split into
    a base term (all trigrams as unseen) plus a correction for trigrams the language has seen.
    """
    d = documents.select("doc_id", "lang", "text")
    texts = d.select("doc_id", "lang", folded(F.col("text")).alias("text"))
    counted = materialized_table(trigram_counts(texts.where(F.col("lang").isNotNull()), "lang", "text"), "trigram_counts")
    # the languages are labels: few; one row each reaches the driver
    totals = counted.groupBy("lang").agg(F.sum("c").alias("n")).orderBy("lang").collect()
    # one row per trigram with a column per language, null where the language never showed it
    profile = materialized_table(counted.groupBy("tri").agg(
        *[F.log(F.lit(1.0) + F.sum(F.when(F.col("lang") == t.lang, F.col("c")))).alias(f"w{i}") for i, t in enumerate(totals)]) if totals else counted.select("tri"), "trigram_profile")
    vocabulary = profile.count()
    # while the profile is measured small every task has it, and a text's trigrams meet it where the
    # text is read: what moves is one row per text. Beyond, trigrams are counted per text
    # and one that nearly every text holds is spread over SALTS copies of its profile row
    small = broadcast_if_small(profile)
    if small is not profile:
        met = trigram_sums(texts, "doc_id", "text", profile.collect(), len(totals))  # a few MB at most
        by_doc = met.groupBy("doc_id").agg(F.sum("n").alias("n_total"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(totals))])
    else:
        salted = profile.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = (document_trigrams(texts, "doc_id", "text").groupBy("doc_id", "tri").agg(F.sum("n").alias("n"))
                   .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
                   .join(salted, ["tri", "salt"], "left"))
        by_doc = met.groupBy("doc_id").agg(F.sum("n").alias("n_total"),
                                           *[F.sum(F.col("n") * F.col(f"w{i}")).alias(f"s{i}") for i in range(len(totals))])
    scores = [F.struct((F.col("n_total") * -F.log(F.lit(t.n + vocabulary).cast("double"))
                        + F.coalesce(F.col(f"s{i}"), F.lit(0.0))).alias("score"), F.lit(t.lang).alias("lang"))
              for i, t in enumerate(totals)]
    none = F.lit(None).cast("struct<score: double, lang: string>")  # no labelled text at all
    best = by_doc.select("doc_id", (F.array_max(F.array(*scores)) if scores else none).alias("b"))
    return (d.select("doc_id", "lang").join(best, "doc_id", "left")
             .select("doc_id", "lang", F.col("b.lang").alias("predicted_lang")))
