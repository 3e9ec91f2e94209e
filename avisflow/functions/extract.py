"""Ordered-fallback field extraction and the address/rating helpers of the collector.

Every helper is a built-in expression (regexp_extract, higher-order array functions), so a
page or text is processed inside the JVM in one pass; no Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# ---------------------------------------------------------------------------
# Sentinels and label patterns of the collector.
DEFAULT_AUTHOR = "Anonyme"
DEFAULT_FIELD = "Non spécifié"
DEFAULT_LOCATION = "Non disponible"
ADDRESS_LABEL = r"Adresse : |Adresse:"
RATING_NUMBER = r"(\d+[.,]?\d*)"
TAG = r"<[^>]+>"
SPACE_RUN = r"[ \t\n\x0B\f\r]+"
EDGE_SPACE = r"^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$"
FIRST_WORD = r"([^ \t\n\x0B\f\r]+)"
# Named character references of HTML, the ampersand last.
ENTITIES = [("&nbsp;", "\u00a0"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&quot;", '"'), ("&#39;", "'"),
            ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]
# ---------------------------------------------------------------------------


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_space(c) -> Column:
    """Without any white space at both ends (``trim`` alone takes spaces only)."""
    return F.regexp_replace(_as_col(c), EDGE_SPACE, "")


def decode_entities(c) -> Column:
    """Named character references as the characters a browser shows; ``&amp;`` last."""
    x = _as_col(c)
    for name, char in ENTITIES:
        x = F.replace(x, F.lit(name), F.lit(char))
    return x


def shown(c) -> Column:
    """What a browser shows of a captured attribute or element: no tags, decoded, white space folded."""
    plain = decode_entities(F.regexp_replace(_as_col(c), TAG, " "))
    return trim_space(F.regexp_replace(plain, SPACE_RUN, " "))


def first_match(source, patterns: Sequence[str], default: str | None) -> Column:
    """COL-3: first non-empty capture of group 1 over ``patterns``, as shown, else ``default``."""
    s = _as_col(source)
    options = [F.nullif(shown(F.regexp_extract(s, p, 1)), F.lit("")) for p in patterns]
    if default is not None:
        options.append(F.lit(default))
    return F.coalesce(*options)


def strip_tags(c) -> Column:
    return F.regexp_replace(_as_col(c), TAG, "")


def address_clean(c) -> Column:
    """COL-4: drop the label, split lines, strip white space, drop empty lines, join with ', '."""
    lines = F.split(F.regexp_replace(_as_col(c), ADDRESS_LABEL, ""), "\n")
    return F.array_join(F.filter(F.transform(lines, lambda x: trim_space(x)), lambda y: y != ""), ", ")


def looks_like_address(c) -> Column:
    """COL-5 predicate: has a digit and more than two words."""
    x = _as_col(c)
    words = F.filter(F.split(x, r"\s+"), lambda w: w != "")
    return x.rlike(r"\p{Nd}") & (F.size(words) > 2)


def address_guess(text, default: str | None = DEFAULT_LOCATION) -> Column:
    """COL-5: first line of the text that looks like an address."""
    lines = F.split(_as_col(text), "\n")
    hit = F.try_element_at(F.filter(lines, lambda l: looks_like_address(l)), F.lit(1))
    return hit if default is None else F.coalesce(hit, F.lit(default))


def rating_text(label) -> Column:
    """COL-6: first number in a rating label, decimal comma -> dot; label kept when no number."""
    x = _as_col(label)
    num = F.regexp_extract(x, RATING_NUMBER, 1)
    return F.when(num != "", F.replace(num, F.lit(","), F.lit("."))).otherwise(x)


def rating_value(label) -> Column:
    return rating_text(label).try_cast("double")
