"""Porter stemming of single words, for use inside Arrow batches.

The algorithm is M. F. Porter, "An algorithm for suffix stripping" (1980) with the later additions that
are usual in summary scoring: a few irregular words, `-ie` kept for four-letter words, `y -> i` only after
a consonant, `bli`, `fulli` and `logi`. Rules are data; `stem` walks through the tables.
"""

from __future__ import annotations

import re

# --- Fixed values: irregular words and the suffix tables of the algorithm ----------------------
IRREGULAR = {
    "skies": "sky",
    "sky": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "news": "news",
    "innings": "inning",
    "inning": "inning",
    "outings": "outing",
    "outing": "outing",
    "cannings": "canning",
    "canning": "canning",
    "howe": "howe",
    "proceed": "proceed",
    "exceed": "exceed",
    "succeed": "succeed",
}
STEP_2 = (
    ("ational", "ate"),
    ("tional", "tion"),
    ("enci", "ence"),
    ("anci", "ance"),
    ("izer", "ize"),
    ("bli", "ble"),
    ("alli", "al"),
    ("entli", "ent"),
    ("eli", "e"),
    ("ousli", "ous"),
    ("ization", "ize"),
    ("ation", "ate"),
    ("ator", "ate"),
    ("alism", "al"),
    ("iveness", "ive"),
    ("fulness", "ful"),
    ("ousness", "ous"),
    ("aliti", "al"),
    ("iviti", "ive"),
    ("biliti", "ble"),
    ("fulli", "ful"),
)
STEP_3 = (
    ("icate", "ic"),
    ("ative", ""),
    ("alize", "al"),
    ("iciti", "ic"),
    ("ical", "ic"),
    ("ful", ""),
    ("ness", ""),
)
STEP_4 = (
    "al",
    "ance",
    "ence",
    "er",
    "ic",
    "able",
    "ible",
    "ant",
    "ement",
    "ment",
    "ent",
    "ion",
    "ou",
    "ism",
    "ate",
    "iti",
    "ous",
    "ive",
    "ize",
)


def _shape(word: str) -> str:
    """`c`/`v` per letter; `y` is a vowel exactly when it follows a consonant."""
    shape = ""
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and shape.endswith("c"))
        shape += "v" if vowel else "c"
    return shape


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _closed_syllable(word: str) -> bool:
    """Ends consonant-vowel-consonant (last not w, x, y), or is just vowel-consonant."""
    shape = _shape(word)
    return shape == "vc" or (shape.endswith("cvc") and word[-1] not in "wxy")


def _first_fit(word: str, rules, keep) -> str:
    """Apply the first rule whose suffix fits; if its stem is refused the word stays."""
    for suffix, new in rules:
        if word.endswith(suffix):
            base = word[: len(word) - len(suffix)]
            return base + new if keep(base) else word
    return word


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past_and_progressive(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    cut = re.match(r"(.*)(?:ed|ing)$", word)
    if not cut or "v" not in _shape(cut[1]):
        return word
    base = cut[1]
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if len(base) > 1 and base[-1] == base[-2] and _shape(base)[-1] == "c":
        return base if base[-1] in "lsz" else base[:-1]
    return base + "e" if _measure(base) == 1 and _closed_syllable(base) else base


def _final_y(word: str) -> str:
    base = word[:-1]
    return base + "i" if word.endswith("y") and len(base) > 1 and _shape(base)[-1] == "c" else word


def _double_suffix(word: str) -> str:
    while word.endswith("alli") and _measure(word[:-4]) > 0:
        word = word[:-2]
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _first_fit(word, STEP_2, lambda base: _measure(base) > 0)


def _single_suffix(word: str) -> str:
    for suffix in STEP_4:
        if word.endswith(suffix):
            base = word[: len(word) - len(suffix)]
            fits = _measure(base) > 1 and (suffix != "ion" or base[-1:] in ("s", "t"))
            return base if fits else word
    return word


def _final_e_and_double_l(word: str) -> str:
    if word.endswith("e"):
        base, size = word[:-1], _measure(word[:-1])
        if size > 1 or (size == 1 and not _closed_syllable(base)):
            word = base
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


def stem(word: str) -> str:
    """Stem of one lower-case word. Words of one or two letters stay."""
    if word in IRREGULAR or len(word) <= 2:
        return IRREGULAR.get(word, word)
    word = _final_y(_past_and_progressive(_plural(word)))
    word = _first_fit(_double_suffix(word), STEP_3, lambda base: _measure(base) > 0)
    return _final_e_and_double_l(_single_suffix(word))


def scoring_stem(word: str) -> str:
    """Overlap scoring stems only words longer than three letters."""
    return stem(word) if len(word) > 3 else word
