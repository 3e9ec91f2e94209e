"""COL-1..9: the collector's data shaping, re-aimed as Spark jobs over fetched pages.

The browser itself is not rebuilt; these run over a table of raw pages (``pages``: page_id,
url, html) and raw texts (``documents``), one row per page/text, whole HTML/text each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from avisflow.functions import extract as X
from avisflow.operators.elements import repeated_elements

# ---------------------------------------------------------------------------
# Selector fallbacks per field, tried in order (generic HTML forms of the
# collector's class/aria selectors).
TITLE_PATTERNS = [r"(?s)<title>(.*?)</title>", r"(?s)<h1>(.*?)</h1>"]
AUTHOR_PATTERNS = [r'<meta name="author" content="([^"]*)"', r'(?s)<span class="author">(.*?)</span>',
                   r"<footer>&copy; ([^ <]+)"]
RATING_PATTERNS = [r'aria-label="([^"]*étoile[^"]*)"', r'aria-label="([^"]*star[^"]*)"', r'data-rating="([^"]*)"']
DATE_PATTERNS = [r'<time[^>]*>([^<]*)</time>', r'(?s)<span class="date">(.*?)</span>']
TEXT_PATTERNS = [r'(?s)<div class="review-text">(.*?)</div>', r"(?s)<article>(.*)</article>", r"(?s)<h1>(.*?)</h1>"]
ADDRESS_PATTERNS = [r'aria-label="(Adresse[^"]*)"', r"(?s)<address>(.*?)</address>"]
FOOTER_PATTERN = r"(?s)<footer>(.*?)</footer>"
LINK_PATTERN = r'<li><a href="([^"]*)">([^<]*)</a></li>'
PARAGRAPH_PATTERN = r"(?s)<p>(.*?)</p>"
HOST_PATTERN = r"^(https?://[^/?#]+)"
# Class and aria-label selectors of a review and of the fields inside it, tried in order.
REVIEW_ELEMENTS = ["jftiEf", "gws-localreviews__google-review"]
REVIEW_FIELDS = {
    "author": [("class", "d4r55"), ("class", "review__author"), ("class", "section-review-title")],
    "rating": [("class_label", "kvMYJc"), ("label", "étoile"), ("label", "star")],
    "date": [("class", "rsqaWe"), ("class", "section-review-publish-date")],
    "text": [("class", "wiI7pd"), ("class", "section-review-text"), ("class", "review-full-text")],
}
REVIEW_DEFAULTS = {"author": X.DEFAULT_AUTHOR, "rating": X.DEFAULT_FIELD, "date": X.DEFAULT_FIELD, "text": X.DEFAULT_FIELD}
REVIEW_PAGES = 1_000_000_000_000  # ids of the built review pages start here
# ---------------------------------------------------------------------------


def with_review_pages(pages: DataFrame) -> DataFrame:
    """The pages, plus one review page per page built by rule (ids behind REVIEW_PAGES): the fetched
    pages hold no rating, date or address markup, so each field's patterns and its default have
    rows to decide on, and some reviews lack both author and text."""
    i = F.col("page_id")

    def part(condition, *pieces):
        return F.when(condition, F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])).otherwise(F.lit(""))

    n = i.cast("string")
    page = F.concat(
        F.lit("<html>"), part(i % 7 != 6, "<title>Agence ", n, " &amp; Cie</title>"),
        part(i % 3 == 0, '<span class="author">\t Client&nbsp;', n, " \r\n</span>"),
        part(i % 4 == 0, '<span aria-label="', ((i % 5) + 1).cast("string"), ',5 étoiles"></span>'),
        part(i % 4 == 1, '<span aria-label="', ((i % 5) + 1).cast("string"), ' stars"></span>'),
        part(i % 4 == 2, '<span data-rating="aucune"></span>'),
        part(i % 2 == 0, "<time datetime=x>il y a ", n, " jours</time>"),
        part(i % 10 == 1, '<span class="date">2024-05-01</span>'),
        part(i % 5 == 1, '<i aria-label="Adresse : ', n, ' rue Neuve, Casablanca"></i>'),
        part(i % 5 == 2, "<address>\t", n, " bd Hassan\r\n  20000 Rabat </address>"),
        part(i % 5 == 3, "<footer>Contact\n", n, " avenue de la Paix</footer>"),
        part(i % 6 != 5, '<div class="review-text">Service <b>rapide</b> &amp; très bon,<br>avis ', n, "</div>"),
        F.lit("</html>"))
    return pages.select("page_id", "url", "html").unionByName(
        pages.select((i + REVIEW_PAGES).alias("page_id"), "url", page.alias("html")))


def with_review_lists(pages: DataFrame) -> DataFrame:
    """The pages with a list of reviews behind their own markup, one per paragraph: nested elements
    of the same name, two class names, missing fields, and a reply that is a review inside a review."""
    def review(p, i):
        n, stars = i.cast("string"), (i % 5 + 1).cast("string")

        def part(*pieces):
            return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in pieces])

        none = F.lit("")
        return F.concat(
            F.lit('<div class="'), F.when(F.col("page_id") % 3 == 2, F.lit(REVIEW_ELEMENTS[1])).otherwise(F.lit(REVIEW_ELEMENTS[0] + " fontBodyMedium")),
            part('" data-review-id=', n, ">"),
            F.when(i % 4 != 3, part('<div class="d4r55 x">Client <b>', n, "</b>&nbsp;</div>")).otherwise(none),
            F.when(i % 3 == 0, part('<span class="kvMYJc" aria-label="', stars, ',5 étoiles"></span>'))
             .when(i % 3 == 1, part("<span aria-label='", stars, " stars'><i></i></span>")).otherwise(none),
            F.when(i % 2 == 0, part("<span class=rsqaWe>il y a ", n, " jours</span>"))
             .when(i % 5 == 1, part('<span class="section-review-publish-date">2024-05-01</span>')).otherwise(none),
            F.when(i % 5 != 4, part('<div class="MyEned"><div class="wiI7pd"><div>', p, "</div> suite <img src=x></div><div></div></div>")).otherwise(none),
            F.when(i % 7 == 6, part('<div class="reply jftiEf"><span class="d4r55"> </span><div class="review__author">Agence</div></div>')).otherwise(none),
            F.lit("</div>"))

    paragraphs = F.regexp_extract_all("html", F.lit(PARAGRAPH_PATTERN), 1)
    reviews = F.array_join(F.transform(paragraphs, review), "")
    return pages.select("page_id", "url", F.concat("html", F.lit('<div class="m6QErb">'), reviews, F.lit("</div>")).alias("html"))


def page_reviews(pages: DataFrame) -> DataFrame:
    """COL-3 + COL-7 over repeated elements: every review of a page with the fields inside its own
    element; reviews without author and text go."""
    found = repeated_elements(pages, "page_id", "html", REVIEW_ELEMENTS, REVIEW_FIELDS)

    def field(name):
        shown = F.filter(F.transform(F.col(name), lambda c: X.shown(c)), lambda c: c != "")
        return F.coalesce(F.try_element_at(shown, F.lit(1)), F.lit(REVIEW_DEFAULTS[name]))

    out = found.select("page_id", "position", field("author").alias("author"), X.rating_text(field("rating")).alias("rating"),
                       field("date").alias("date"), field("text").alias("text"))
    return out.where((F.col("author") != X.DEFAULT_AUTHOR) | (F.col("text") != X.DEFAULT_FIELD))


def page_review_counts(pages: DataFrame) -> DataFrame:
    """COL-8 over the reviews found in pages: kept reviews per host plus the grand total."""
    host = pages.select("page_id", F.regexp_extract("url", HOST_PATTERN, 1).alias("host"))
    return (page_reviews(pages).select("page_id").join(host, "page_id").rollup("host")
            .agg(F.count(F.lit(1)).alias("review_count"), F.grouping("host").cast("int").alias("is_total")))


def bank_from_query(pages: DataFrame) -> DataFrame:
    """COL-1: the page title is the search target; its first whitespace token is the bank."""
    q = X.first_match("html", TITLE_PATTERNS[:1], X.DEFAULT_FIELD)
    return pages.select("page_id", q.alias("query")).withColumn("bank", F.regexp_extract("query", X.FIRST_WORD, 1))


def place_links(pages: DataFrame) -> DataFrame:
    """Search-result places: every nav link of a page (name, absolute url) with its position."""
    host = F.regexp_extract("url", HOST_PATTERN, 1)
    q = X.first_match("html", TITLE_PATTERNS[:1], X.DEFAULT_FIELD)
    links = F.arrays_zip(F.regexp_extract_all("html", F.lit(LINK_PATTERN), 1).alias("href"),
                         F.regexp_extract_all("html", F.lit(LINK_PATTERN), 2).alias("name"))
    return (pages.select("page_id", host.alias("host"), q.alias("query"), F.posexplode(links).alias("pos", "l"))
                 .select("page_id", "pos", "query",
                         F.regexp_extract("query", X.FIRST_WORD, 1).alias("bank"),
                         X.shown("l.name").alias("agency"),
                         F.concat(F.col("host"), F.col("l.href")).alias("url")))


def agency_urls(pages: DataFrame) -> DataFrame:
    """COL-2: places with a name and a url; duplicate urls keep the first seen (page, position).
    ``row_number() = 1`` is limited map-side before the shuffle, so a url repeated on a third
    of all pages costs one row per map task in the exchange."""
    links = place_links(pages).where((F.col("agency") != "") & (F.col("url") != ""))
    w = Window.partitionBy("url").orderBy("page_id", "pos")
    return (links.withColumn("__rn", F.row_number().over(w)).where("__rn = 1")
                 .select("bank", "query", "agency", "url", F.col("page_id").alias("source_page")))


def page_field_extract(pages: DataFrame) -> DataFrame:
    """COL-3: ordered fallbacks per field with the collector's sentinels."""
    review_text = X.first_match("html", TEXT_PATTERNS, X.DEFAULT_FIELD)
    rating_label = X.first_match("html", RATING_PATTERNS, X.DEFAULT_FIELD)
    raw_address = [F.nullif(X.trim_space(X.decode_entities(X.strip_tags(F.regexp_extract("html", p, 1)))), F.lit(""))
                   for p in ADDRESS_PATTERNS]  # lines stay apart here
    location = F.coalesce(*raw_address,
                          X.address_guess(X.strip_tags(F.regexp_extract("html", FOOTER_PATTERN, 1)), None),
                          F.lit(X.DEFAULT_LOCATION))
    return pages.select(
        "page_id",
        X.first_match("html", TITLE_PATTERNS, X.DEFAULT_FIELD).alias("agency"),
        X.first_match("html", AUTHOR_PATTERNS, X.DEFAULT_AUTHOR).alias("author"),
        X.rating_text(rating_label).alias("rating"),
        X.first_match("html", DATE_PATTERNS, X.DEFAULT_FIELD).alias("date"),
        review_text.alias("text"),
        F.when(location == X.DEFAULT_LOCATION, location).otherwise(X.address_clean(location)).alias("location"),
    )


def review_keep(pages: DataFrame) -> DataFrame:
    """COL-7: keep a review unless both author and text fell back to their sentinels."""
    f = page_field_extract(pages)
    return f.where((F.col("author") != X.DEFAULT_AUTHOR) | (F.col("text") != X.DEFAULT_FIELD))


def address_guess(documents: DataFrame) -> DataFrame:
    """COL-5 over whole texts: the first line with a digit and more than two words."""
    return documents.select("doc_id", X.address_guess("text").alias("location"))


def address_clean(documents: DataFrame) -> DataFrame:
    """COL-4 over whole texts."""
    return documents.select("doc_id", X.address_clean("text").alias("location"))


def rating_parse(documents: DataFrame) -> DataFrame:
    """COL-6 over whole texts: first number, comma -> dot, then a safe cast."""
    return documents.select("doc_id", X.rating_text("text").alias("rating_text"),
                            X.rating_value("text").alias("rating"))


def reviews_per_agency(staging: DataFrame) -> DataFrame:
    """COL-8: reviews per agency plus the grand total (ROLLUP); ``is_total`` marks it."""
    return (staging.rollup("agency")
                   .agg(F.count(F.lit(1)).alias("review_count"), F.grouping("agency").cast("int").alias("is_total")))


def agency_details(pages: DataFrame) -> DataFrame:
    """COL-9: one row per agency url with its page's location."""
    loc = page_field_extract(pages).select(F.col("page_id").alias("source_page"), "location")
    return agency_urls(pages).join(loc, "source_page", "left").select("bank", "agency", "url", "location").distinct()
