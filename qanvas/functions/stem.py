"""Porter's stemmer as native expressions: a cascade of steps, each computed once a word.

It has the usual extensions: words of one or two letters stay, a few irregular words, `-ies` and `-ied` of four letters,
`-bli`, `-fulli` and `-logi`, `-alli` before other endings. A word is lowered; an initial y is a consonant.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, once

# Fixed values of the published algorithm: endings with what replaces them, in the order in which they are tried.
STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"),
    ("biliti", "ble"), ("fulli", "ful"), ("logi", "log"),
]
STEP_3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
STEP_4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news", "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
# What the conditions of the algorithm are as patterns. An initial y is upper case, so it is no vowel here.
CONSONANTS, VOWELS = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
#: The measure of a stem is over 0, is 1, is over 1; the stem has a vowel.
OVER_0, IS_1, OVER_1 = f"^({CONSONANTS})?{VOWELS}{CONSONANTS}", f"^({CONSONANTS})?{VOWELS}{CONSONANTS}({VOWELS})?$", f"^({CONSONANTS})?({VOWELS}{CONSONANTS}){{2}}"
HAS_VOWEL = f"^({CONSONANTS})?[aeiouy]"
#: Consonant, vowel, consonant other than w, x, y at the end of a stem of measure 1; or vowel and consonant alone.
SHORT_END = f"^{CONSONANTS}[aeiouy][^aeiouwxy]$|^[aeiou][^aeiou]$"


def _less(w: Column, n: int) -> Column:
    """w without its last n letters."""
    return F.substring(w, F.lit(1), F.length(w) - n)


def _plural(w: Column) -> Column:
    four = F.length(w) == 4
    return F.when(w.endswith("ies") & four, _less(w, 1)).when(w.endswith("sses") | w.endswith("ies"), _less(w, 2)).when(w.endswith("ss"), w).when(w.endswith("s"), _less(w, 1)).otherwise(w)


def _mended(s: Column) -> Column:
    """A stem that has lost -ed or -ing."""
    double = (F.substring(s, -1, 1) == F.substring(s, -2, 1)) & (F.length(s) > 1) & s.rlike("[^aeiou]$")
    with_e = s.rlike("(at|bl|iz)$") | (~double & s.rlike(IS_1) & s.rlike(SHORT_END))
    return F.when(with_e, F.concat(s, F.lit("e"))).when(double & ~s.rlike("[lsz]$"), _less(s, 1)).otherwise(s)


def _past(w: Column) -> Column:
    return (
        F.when(w.endswith("ied"), F.when(F.length(w) == 4, _less(w, 1)).otherwise(_less(w, 2)))
        .when(w.endswith("eed"), F.when(_less(w, 3).rlike(OVER_0), _less(w, 1)).otherwise(w))
        .when(w.endswith("ed") & _less(w, 2).rlike(HAS_VOWEL), once(_less(w, 2), _mended))
        .when(w.endswith("ing") & _less(w, 3).rlike(HAS_VOWEL), once(_less(w, 3), _mended)).otherwise(w)
    )


def _final_y(w: Column) -> Column:
    return F.when(w.endswith("y") & (F.length(w) > 2) & _less(w, 1).rlike("[^aeiouy]$"), F.concat(_less(w, 1), F.lit("i"))).otherwise(w)


def _replaced(w: Column, endings: list[tuple[str, str]]) -> Column:
    """The first ending that fits decides: it is replaced if the stem's measure is over 0."""
    out = None
    for ending, by in endings:
        # The l of -logi counts as part of the stem.
        stem = _less(w, len(ending) - (ending == "logi"))
        then = F.when(stem.rlike(OVER_0), F.concat(_less(w, len(ending)), F.lit(by))).otherwise(w)
        out = F.when(w.endswith(ending), then) if out is None else out.when(w.endswith(ending), then)
    return out.otherwise(w)


def _long_endings(w: Column) -> Column:
    short = F.when(w.endswith("alli") & _less(w, 4).rlike(OVER_0), _less(w, 2)).otherwise(w)
    return once(short, lambda x: _replaced(x, STEP_2))


def _dropped(w: Column) -> Column:
    out = None
    for ending in STEP_4:
        stem = _less(w, len(ending))
        fits = stem.rlike(OVER_1) & stem.rlike("[st]$") if ending == "ion" else stem.rlike(OVER_1)
        then = F.when(fits, stem).otherwise(w)
        out = F.when(w.endswith(ending), then) if out is None else out.when(w.endswith(ending), then)
    return out.otherwise(w)


def _final_e(w: Column) -> Column:
    s = _less(w, 1)
    return F.when(w.endswith("e") & (s.rlike(OVER_1) | (s.rlike(IS_1) & ~s.rlike(SHORT_END))), s).otherwise(w)


def _final_l(w: Column) -> Column:
    return F.when(w.endswith("ll") & _less(w, 1).rlike(OVER_1), _less(w, 1)).otherwise(w)


def stem(c: Column | str) -> Column:
    """The stem of a word. Null stays null."""

    def steps(w: Column) -> Column:
        out = F.when(w.startswith("y"), F.concat(F.lit("Y"), F.substring(w, F.lit(2), F.length(w)))).otherwise(w)
        for step in (_plural, _past, _final_y, _long_endings, lambda x: _replaced(x, STEP_3), _dropped, _final_e, _final_l):
            out = once(out, step)
        known = F.create_map(*[F.lit(x) for pair in IRREGULAR.items() for x in pair])
        return F.when(F.length(w) <= 2, w).otherwise(F.coalesce(known[w], F.lower(out)))

    return F.when(col(c).isNotNull(), once(F.lower(col(c)), steps))
