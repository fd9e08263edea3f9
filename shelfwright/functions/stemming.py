"""Accent folding and English suffix stripping for search terms.

Run over the distinct terms of a row through an Arrow function; the text itself never goes through Python.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Suffix pairs of the published Porter (1980) algorithm, steps 2, 3 and 4.
STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
]
STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
]


_PLAIN = re.compile(r"[a-z]+")
_VOWEL_RUN = re.compile(r"v+c+")


def _shape(word: str) -> str:
    """The word as a string of c(onsonant) and v(owel)."""
    out: list[str] = []
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[i - 1] != "v")
        out.append("v" if vowel else "c")
    return "".join(out)


def _measure(stem: str) -> int:
    return len(_VOWEL_RUN.findall(_shape(stem)))


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _ends_cvc(stem: str) -> bool:
    return _shape(stem).endswith("cvc") and stem[-1] not in "wxy"


def _ends_double(stem: str) -> bool:
    return len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c"


def _longest_first(suffixes: list) -> list:
    return sorted(suffixes, key=lambda s: len(s if isinstance(s, str) else s[0]), reverse=True)


_STEP_2, _STEP_3, _STEP_4 = map(_longest_first, (STEP_2, STEP_3, STEP_4))


def _replace_longest(word: str, pairs: list[tuple[str, str]]) -> str:
    for suffix, new in pairs:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + new if _measure(stem) > 0 else word
    return word


def _drop_inflection(word: str) -> str:
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: -len(suffix)]
        if word.endswith(suffix):
            if not _has_vowel(stem):
                return word
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if _ends_double(stem) and stem[-1] not in "lsz":
                return stem[:-1]
            return stem + "e" if _measure(stem) == 1 and _ends_cvc(stem) else stem
    return word


def stem(word: str) -> str:
    """Porter stem of an already folded word; anything but a-z of 3 or more letters is left alone."""
    if len(word) < 3 or not _PLAIN.fullmatch(word):
        return word
    word = _drop_inflection(word)
    if word.endswith("y") and _has_vowel(word[:-1]):
        word = word[:-1] + "i"
    word = _replace_longest(word, _STEP_2)
    word = _replace_longest(word, _STEP_3)
    for suffix in _STEP_4:
        if word.endswith(suffix):
            base = word[: -len(suffix)]
            if _measure(base) > 1 and (suffix != "ion" or base.endswith(("s", "t"))):
                word = base
            break
    if word.endswith("e"):
        base = word[:-1]
        if _measure(base) > 1 or (_measure(base) == 1 and not _ends_cvc(base)):
            word = base
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def fold(word: str) -> str:
    """Lower case without diacritics."""
    if word.isascii():
        return word.lower()
    parts = unicodedata.normalize("NFD", word.lower())
    return "".join(ch for ch in parts if not unicodedata.combining(ch))


_FORMS: dict[str, str] = {}
_MOST_FORMS = 500_000  # remembered by a worker before it starts over


def _form(word: str) -> str:
    form = _FORMS.get(word)
    if form is None:
        if len(_FORMS) >= _MOST_FORMS:
            _FORMS.clear()
        form = _FORMS[word] = stem(fold(word))
    return form


@F.pandas_udf(ArrayType(StringType()))
def search_forms(words: pd.Series) -> pd.Series:
    """The distinct folded and stemmed forms of each list of terms; a worker stems a term once."""
    return words.map(lambda row: None if row is None else list(dict.fromkeys(map(_form, row))))
