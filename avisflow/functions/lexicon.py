"""In-repo sentiment lexicon and negators (our own values; the scoring libraries the
reference calls are not available, so scores are ours by design — see README)."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Word -> weight in [-3.5, 3.5], multiples of 0.5 (exact in binary floating
# point, so sums are identical in every engine). English and French review vocabulary.
LEXICON = {
    # English, positive
    "good": 1.5, "great": 2.5, "excellent": 3.0, "amazing": 3.0, "awesome": 3.0, "perfect": 3.0,
    "nice": 1.5, "friendly": 2.0, "helpful": 2.0, "fast": 1.0, "quick": 1.0, "efficient": 1.5,
    "professional": 1.5, "polite": 1.5, "kind": 1.5, "happy": 2.0, "satisfied": 2.0, "love": 3.0,
    "best": 3.0, "recommend": 1.5, "clean": 1.0, "easy": 1.0, "welcoming": 2.0, "thanks": 1.5,
    "thank": 1.5, "pleasant": 2.0, "reliable": 1.5, "smooth": 1.0, "fine": 0.5, "better": 1.5,
    # English, negative
    "bad": -2.0, "terrible": -3.0, "awful": -3.0, "horrible": -3.0, "worst": -3.5, "poor": -2.0,
    "slow": -1.5, "rude": -2.5, "unhelpful": -2.0, "useless": -2.5, "worthless": -2.5, "wait": -0.5,
    "waiting": -1.0, "late": -1.0, "dirty": -1.5, "angry": -2.5, "disappointed": -2.0, "problem": -1.0,
    "problems": -1.0, "issue": -1.0, "expensive": -1.5, "fees": -0.5, "never": -0.5, "hate": -3.0,
    "scam": -3.5, "fraud": -3.5, "broken": -2.0, "closed": -0.5, "lost": -1.5, "worse": -2.0,
    # French, positive
    "bon": 1.5, "bonne": 1.5, "bien": 1.0, "excellent": 3.0, "excellente": 3.0, "parfait": 3.0,
    "super": 2.5, "génial": 3.0, "agréable": 2.0, "aimable": 2.0, "accueillant": 2.0, "rapide": 1.0,
    "efficace": 1.5, "professionnel": 1.5, "satisfait": 2.0, "merci": 1.5, "recommande": 1.5,
    "top": 2.0, "sympathique": 2.0, "disponible": 1.0, "compétent": 1.5, "meilleur": 2.5,
    # French, negative
    "mauvais": -2.0, "mauvaise": -2.0, "nul": -2.5, "nulle": -2.5, "horrible": -3.0, "lent": -1.5,
    "lente": -1.5, "attente": -1.0, "impoli": -2.5, "désagréable": -2.5, "cher": -1.5, "chère": -1.5,
    "problème": -1.0, "déçu": -2.0, "déçue": -2.0, "catastrophe": -3.5, "arnaque": -3.5, "pire": -3.0,
    "fermé": -0.5, "inadmissible": -3.0, "honte": -3.0, "incompétent": -2.5,
    # Arabic
    "جيد": 1.5, "ممتاز": 3.0, "سيء": -2.0, "شكرا": 1.5,
}
# A word directly after one of these flips the sign of its weight.
NEGATORS = ["not", "no", "never", "none", "nobody", "nothing", "nor", "without", "cannot",
            "ne", "pas", "jamais", "sans", "aucun", "aucune", "rien", "ni", "لا"]
# Compound normalisation s / sqrt(s^2 + ALPHA) (Hutto & Gilbert 2014).
ALPHA = 15.0
# Polarity: mean matched weight divided by the largest weight magnitude.
MAX_WEIGHT = 3.5
TOKEN_PATTERN = r"\p{L}+"
# ---------------------------------------------------------------------------
