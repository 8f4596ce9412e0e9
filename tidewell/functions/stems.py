"""The suffix algorithm of M. F. Porter (Program 14, 1980).

A word's letters are classed as vowels and consonants in a string beside it, of which a stem's part is a prefix; the
measure of a stem is the number of places where a consonant follows a vowel.
"""

from __future__ import annotations

import functools
from collections.abc import Collection, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words whose stems a Python worker remembers.
MEMORY = 1 << 20

# The published suffixes and what replaces them.
STEP_1A = {"sses": "ss", "ies": "i", "ss": "ss", "s": ""}
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
    "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti",
    "ous", "ive", "ize",
)


def _classes(word: str) -> str:
    """``v`` or ``c`` for each letter; ``y`` is a vowel behind a consonant."""
    out = ""
    for x in word:
        out += "v" if x in "aeiou" or (x == "y" and out[-1:] == "c") else "c"
    return out


def _measure(word: str) -> int:
    return _classes(word).count("vc")


def _suffix(word: str, suffixes: Collection[str]) -> str:
    """The longest of the suffixes that ends the word, none: empty."""
    return next((word[-n:] for n in range(min(7, len(word)), 0, -1) if word[-n:] in suffixes), "")


def _replaced(word: str, rules: dict[str, str], least: int) -> str:
    """The word with the longest suffix of ``rules`` replaced, if the measure of its stem is ``least``."""
    suffix = _suffix(word, rules)
    stem = word[:len(word) - len(suffix)]
    return stem + rules[suffix] if suffix and (not least or _measure(stem) >= least) else word


def _short_end(word: str) -> bool:
    """The end is consonant, vowel, consonant, and the last is not w, x or y."""
    return _classes(word).endswith("cvc") and word[-1] not in "wxy"


def _step_1b(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) else word
    if not word.endswith(("ed", "ing")):
        return word
    cut = word[:-3] if word.endswith("ing") else word[:-2]
    classes = _classes(cut)
    if "v" not in classes:
        return word
    if cut.endswith(("at", "bl", "iz")):
        return cut + "e"
    if classes.endswith("cc") and cut[-1] == cut[-2] and cut[-1] not in "lsz":
        return cut[:-1]
    return cut + "e" if classes.count("vc") == 1 and _short_end(cut) else cut


@functools.lru_cache(maxsize=MEMORY)
def stem(word: str) -> str:
    """Stem of a lower-cased word; words of one or two letters stay as they are. Other than a-z letters count as consonants."""
    if len(word) <= 2:
        return word
    out = _step_1b(_replaced(word, STEP_1A, 0))
    if out.endswith("y") and "v" in _classes(out[:-1]):
        out = out[:-1] + "i"
    out = _replaced(_replaced(out, STEP_2, 1), STEP_3, 1)
    suffix = _suffix(out, STEP_4)
    if suffix and _measure(out[:-len(suffix)]) > 1 and (suffix != "ion" or out.endswith(("sion", "tion"))):
        out = out[:-len(suffix)]
    if out.endswith("e") and ((n := _measure(out[:-1])) > 1 or (n == 1 and not _short_end(out[:-1]))):
        out = out[:-1]
    return out[:-1] if out.endswith("ll") and _measure(out) > 1 else out


def porter(word: Column) -> Column:
    """:func:`stem` of a column."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([None if w is None else stem(w) for w in batch.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")(word)
