"""Stop words of the topic preprocessing.

English: Spark ML's default English list (what ``StopWordsRemover.loadDefaultStopWords``
returns), kept here as a literal so that importing needs neither a JVM nor Spark's jars.
French and Arabic: the reference's own lists.
"""

from __future__ import annotations

from functools import lru_cache

# ---------------------------------------------------------------------------
# Spark ML's default English stop words.
ENGLISH_STOPWORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself", "they",
    "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these", "those",
    "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does",
    "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at",
    "by", "for", "with", "about", "against", "between", "into", "through", "during", "before", "after", "above",
    "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again", "further", "then",
    "once", "here", "there", "when", "where", "why", "how", "all", "any", "both", "each", "few", "more", "most",
    "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t",
    "can", "will", "just", "don", "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll",
    "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're",
    "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't", "haven't",
    "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't", "shouldn't", "mustn't",
    "can't", "couldn't", "cannot", "could", "here's", "how's", "let's", "ought", "that's", "there's", "what's",
    "when's", "where's", "who's", "why's", "would",
]
# The reference's French and Arabic stop-word sets.
FRENCH_STOPWORDS = [
    "le", "de", "et", "à", "un", "il", "être", "et", "en", "avoir", "que", "pour",
    "dans", "ce", "son", "une", "sur", "avec", "ne", "se", "pas", "tout", "plus",
    "par", "grand", "en", "le", "bien", "autre", "pour", "ce", "tout", "mais",
    "très", "bon", "service", "banque", "agence", "personnel", "client",
]
ARABIC_STOPWORDS = [
    "في", "من", "إلى", "على", "مع", "هذا", "هذه", "التي", "الذي", "كان", "كانت",
    "يكون", "تكون", "لا", "ما", "إن", "أن", "قد", "لقد", "كل", "بعض", "جميع",
]
# ---------------------------------------------------------------------------

@lru_cache(maxsize=1)
def all_stopwords() -> tuple[str, ...]:
    return tuple(sorted(set(ENGLISH_STOPWORDS) | set(FRENCH_STOPWORDS) | set(ARABIC_STOPWORDS)))
