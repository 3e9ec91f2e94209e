"""Small tables with every odd case, and brute-force forms of the operators."""

import re

ODD_TEXTS = [
    (1, "The same text", "a"), (2, "The same text", "b"), (3, "the same text", "a"), (4, None, "a"), (5, "", None),
    (6, " \t\n ", "b"), (7, "x", "a"), (8, "é ü 日本語 🙂 ▁▁ mark", "b"), (9, "word " * 30000, "a"),
    (10, "word " * 29999 + "ward ", "a"), (11, "word " * 30000, "c"), (12, "\n\n\n", "a"), (13, "a  b   c", None),
    (14, "long" * 9000, "b"), (15, "The same text", "a"), (None, "The same text", "a"), (None, None, None),
    (16, "tie", "a"), (16, "tie", "a"), (17, "token=abcdef12 \0 end", "a"),
]
#: Columns whose names clash with what operators call their own.
EXTRA = ("rid long, block string, fp long, name string, level int, h1 long, words int, size long, taken long, key long, u long, v long, "
         "p_source string, g int, score_ double")


def odd_docs(spark, rows=None):
    rows = ODD_TEXTS if rows is None else rows
    n = len(EXTRA.split(","))
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *([None] * n)) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA)


def components(n, edges):
    """Smallest index reachable from each of n nodes."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
