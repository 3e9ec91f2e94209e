"""Text rules of the staging model: cleaning, language class, length class."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---------------------------------------------------------------------------
# The staging model's language rules as patterns (first match wins). French:
# accented vowels or four marker words; Arabic: seven words; English: six stop words, whole
# words only, with the word edges spelled out, so the rule means the same in every regex engine
# (Java's \\b and RE2's \\b disagree next to accented letters).
FRENCH_PATTERN = "[àáâäèéêëìíîïòóôöùúûü]|ça|très|être|avoir"
ARABIC_PATTERN = "والله|الله|مع|في|على|هذا|هذه"
ENGLISH_PATTERN = "(^|[^a-z0-9_])(the|and|or|of|in|to)([^a-z0-9_]|$)"
# Text-quality thresholds on the trimmed length.
SHORT_BELOW = 10
LONG_ABOVE = 500
# ---------------------------------------------------------------------------

# Every Arabic marker is written in the Arabic block: a one-class scan rules out most texts
# before the seven-way alternation runs (same result, much less work on long texts).
ARABIC_BLOCK = "[" + chr(0x0600) + "-" + chr(0x06FF) + "]"

# Java needs (?iu) to fold accented capitals (TRÈS); (?i) alone is ASCII-only.
SPARK_FLAGS = "(?iu)"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c="review_text") -> Column:
    """STR-1: LOWER(TRIM(x)); TRIM strips spaces only."""
    return F.lower(F.trim(_as_col(c)))


def detected_language(c="review_text") -> Column:
    """CAS-1: ordered regex rules -> fr / ar / en / unknown."""
    t = _as_col(c)
    return (F.when(t.rlike(SPARK_FLAGS + FRENCH_PATTERN), "fr")
             .when(t.rlike(ARABIC_BLOCK) & t.rlike(ARABIC_PATTERN), "ar")
             .when(t.rlike(SPARK_FLAGS + ENGLISH_PATTERN), "en")
             .otherwise("unknown"))


def text_quality(c="review_text") -> Column:
    """CAS-2: short / long / normal on the trimmed length."""
    n = F.length(F.trim(_as_col(c)))
    return (F.when(n < SHORT_BELOW, "short")
             .when(n > LONG_ABOVE, "long")
             .otherwise("normal"))
