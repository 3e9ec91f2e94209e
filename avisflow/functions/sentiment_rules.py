"""Tables of the rule-based scorers: word weights, modifiers, phrases (our own values)."""

from __future__ import annotations

from avisflow.functions.lexicon import LEXICON, NEGATORS

# ---------------------------------------------------------------------------
# All weights and factors are multiples of 1/64, exact in binary floating point.
#: (word, kind, value): boosters add to the size of a weight, the others turn, split or count.
MODIFIERS = [
    *((w, "booster", 0.25) for w in ("very", "really", "so", "extremely", "totally", "absolutely", "too", "très", "trop", "vraiment", "tellement", "extrêmement", "جدا")),
    *((w, "booster", -0.25) for w in ("slightly", "somewhat", "barely", "hardly", "almost", "peu", "presque", "assez", "plutôt")),
    *((w, "negator", 1.0) for w in NEGATORS),
    *((w, "contrast", 1.0) for w in ("but", "however", "although", "mais", "cependant", "pourtant", "لكن")),
]
WORD_WEIGHTS = sorted(LEXICON.items())
#: Words before a word that modify it, and the share of a booster's value by distance.
WINDOW, DAMPING = 3, (1.0, 0.75, 0.5)
NEGATED, CAPITALS, BEFORE_CONTRAST, AFTER_CONTRAST = -0.75, 0.5, 0.5, 1.5
#: Exclamation marks count up to four; question marks from two on.
EXCLAMATION, EXCLAMATIONS, QUESTION, QUESTIONS = 0.25, 4, 0.125, 4
#: (phrase, polarity, subjectivity, intensity): intensity multiplies the entry that follows directly.
PHRASES = [
    ("good", 0.75, 0.625, 1.0), ("great", 0.875, 0.75, 1.0), ("excellent", 1.0, 1.0, 1.0), ("bad", -0.75, 0.6875, 1.0), ("terrible", -1.0, 1.0, 1.0),
    ("slow", -0.3125, 0.375, 1.0), ("fast", 0.25, 0.625, 1.0), ("friendly", 0.375, 0.5, 1.0), ("rude", -0.3125, 0.625, 1.0), ("helpful", 0.5, 0.25, 1.0),
    ("not bad", 0.375, 0.5, 1.0), ("no problem", 0.25, 0.25, 1.0), ("waste of time", -0.75, 0.875, 1.0), ("top notch", 0.9375, 0.75, 1.0), ("out of order", -0.5, 0.25, 1.0),
    ("bon", 0.5, 0.5, 1.0), ("bonne", 0.5, 0.5, 1.0), ("mauvais", -0.625, 0.625, 1.0), ("nul", -0.75, 0.75, 1.0), ("rapide", 0.25, 0.5, 1.0), ("lent", -0.3125, 0.375, 1.0),
    ("pas mal", 0.375, 0.5, 1.0), ("hors service", -0.5, 0.25, 1.0), ("perte de temps", -0.75, 0.875, 1.0), ("à recommander", 0.75, 0.75, 1.0),
    ("very", 0.0, 0.25, 1.25), ("really", 0.0, 0.25, 1.25), ("extremely", 0.0, 0.75, 1.5), ("slightly", 0.0, 0.125, 0.5), ("très", 0.0, 0.25, 1.25), ("trop", 0.0, 0.25, 1.25), ("peu", 0.0, 0.125, 0.5),
    ("worthless", -0.75, 0.75, 1.0), ("stupid", -0.75, 1.0, 1.0), ("pathetic", -1.0, 1.0, 1.0), ("disgusting", -1.0, 1.0, 1.0), ("service", 0.0, 0.0, 1.0),
]
NEGATED_POLARITY = -0.5
# ---------------------------------------------------------------------------
