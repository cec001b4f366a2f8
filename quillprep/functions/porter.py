"""Porter's suffix stripper (Program 14(3), 1980), as a helper for tokens inside a batch."""

from __future__ import annotations

import re
from functools import lru_cache

# The published suffix rules, in their order.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)

_VOWELS_THEN_CONSONANTS = re.compile("v+c+")


def _shape(word: str) -> str:
    """``v`` or ``c`` per letter; y after a consonant is a vowel."""
    shape = ""
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and shape[-1:] == "c")
        shape += "v" if vowel else "c"
    return shape


def _measure(stem: str) -> int:
    return len(_VOWELS_THEN_CONSONANTS.findall(_shape(stem)))


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_end(word: str) -> bool:
    return _shape(word).endswith("cvc") and word[-1] not in "wxy"


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _plural(word: str) -> str:
    for suffix, instead in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if word.endswith(suffix):
            return word[: -len(suffix)] + instead
    return word


def _past(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: -len(suffix)]
        if word.endswith(suffix):
            if not _has_vowel(stem):
                return word
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if _double_consonant(stem) and stem[-1] not in "lsz":
                return stem[:-1]
            if _measure(stem) == 1 and _short_end(stem):
                return stem + "e"
            return stem
    return word


def _replace(word: str, rules) -> str:
    rules = dict(rules)
    suffix = _longest(word, rules)
    if suffix and _measure(word[: -len(suffix)]) > 0:
        return word[: -len(suffix)] + rules[suffix]
    return word


def _drop(word: str) -> str:
    suffix = _longest(word, STEP_4)
    if suffix:
        stem = word[: -len(suffix)]
        if _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
            return stem
    return word


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    """The stem of a lowercase word; words of up to two letters are left alone."""
    if len(word) < 3:
        return word
    word = _past(_plural(word))
    if word.endswith("y") and _has_vowel(word[:-1]):
        word = word[:-1] + "i"
    word = _drop(_replace(_replace(word, STEP_2), STEP_3))
    if word.endswith("e"):
        measure = _measure(word[:-1])
        if measure > 1 or (measure == 1 and not _short_end(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word
