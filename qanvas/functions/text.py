"""Text expressions: native columns, no Python on the executors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicons import APOSTROPHE_ENDS


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def strip(c: Column | str) -> Column:
    r"""White space off both ends, of all kinds that \s has."""
    return F.btrim(col(c), F.lit(" \t\n\x0b\f\r"))


def words(c: Column | str) -> Column:
    """Split at white space, without empty parts."""
    return F.filter(F.split(col(c), r"\s+"), lambda w: w != "")


def word_count(c: Column | str) -> Column:
    return F.size(words(c))


def sentence_parts(c: Column | str) -> Column:
    """Parts between sentence ends; they are numbered before blanks are dropped."""
    return F.split(col(c), r"(?<=[.!?])\s+")


def sentences(c: Column | str) -> Column:
    return F.filter(F.transform(sentence_parts(c), strip), lambda s: s != "")


def paragraphs(c: Column | str, delimiter: str = "\n\n") -> Column:
    """Stripped parts between delimiters; blanks are dropped before numbering."""
    return F.filter(F.transform(F.split(col(c), f"\\Q{delimiter}\\E"), strip), lambda p: p != "")


def lines(c: Column | str) -> Column:
    """Stripped lines that are not blank."""
    return F.filter(F.transform(F.split(col(c), "\n"), strip), lambda x: x != "")


def has_any(low: Column, keywords: list[str]) -> Column:
    """Whether any of the literal keywords is in a text that is lowered already: a plain search for each, no regex."""
    out = F.contains(low, F.lit(keywords[0]))
    for k in keywords[1:]:
        out = out | F.contains(low, F.lit(k))
    return out


def contains_any(text: Column, keywords: list[str]) -> Column:
    """Whether any of the literal keywords is in the text, lowered once."""
    return F.exists(F.array(F.lower(text)), lambda low: has_any(low, keywords))


def clean_references(c: Column | str) -> Column:
    """Without spans from "according to" to the next of ,.!?;: and with runs of white space made one space."""
    cut = F.regexp_replace(col(c), r"(?i)\baccording to\b[^,.!?;:]*[,.!?;:]\s*", "")
    return F.coalesce(strip(F.regexp_replace(cut, r"\s{2,}", " ")), F.lit(""))


def capitalised(c: Column | str) -> Column:
    """A text that begins in lower case gets an upper-case first letter and the rest lowered; others stay."""
    x, first = col(c), F.substring(col(c), 1, 1)
    return F.when(first.rlike(r"^\p{Ll}"), F.concat(F.upper(first), F.lower(F.substr(x, F.lit(2))))).otherwise(x)


def flat_passage(c: Column | str) -> Column:
    return F.replace(col(c), F.lit("\n"), F.lit(" "))


def between_marks(c: Column | str, start: str, end: str, occurrence: int = 1) -> Column:
    """Text between the n-th start mark and the n-th end mark, chosen independently and stripped; null where one is
    missing, empty where the end comes first."""
    x = col(c)
    has = (F.size(F.split(x, f"\\Q{start}\\E")) > occurrence) & (F.size(F.split(x, f"\\Q{end}\\E")) > occurrence)
    at = F.length(F.substring_index(x, start, occurrence)) + len(start)
    to = F.length(F.substring_index(x, end, occurrence))
    return F.when(has, F.when(to >= at, strip(F.substr(x, (at + 1).cast("int"), (to - at).cast("int")))).otherwise(""))


def mask_answer(question: Column | str, answer: Column | str, passage: Column | str, mask: str, n_tokens: Column) -> Column:
    """Question, answer and passage in a line, with every occurrence of the answer made n_tokens masks."""
    line = F.concat_ws(" ", col(question), col(answer), col(passage))
    return F.replace(line, col(answer), F.array_join(F.array_repeat(F.lit(mask), n_tokens.cast("int")), " "))


def mask_word(c: Column | str, mask: str = "[MASK]") -> Column:
    """The word with what lies between its outer punctuation made a mask; a word of punctuation only stays."""
    punctuation = r"!\"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~"
    core = f"^([{punctuation}]*)([^{punctuation}](?:.*[^{punctuation}])?)([{punctuation}]*)$"
    return F.regexp_replace(col(c), core, "$1" + mask.replace("[", r"\[").replace("]", r"\]") + "$3")


def is_word(c: Column | str, in_lexicon=None) -> Column:
    """At most one apostrophe, with t, nt, s or ll behind it; hyphenated parts all words; else alphabetic or listed."""
    known = in_lexicon or (lambda w: F.lit(False))
    plain = lambda w: known(w) | w.rlike(r"^\p{L}+$")
    hyphenated = lambda w: F.forall(F.split(w, "-"), plain)
    x, quotes = col(c), F.size(F.split(col(c), "'")) - 1
    ends = F.substring_index(x, "'", -1).isin(*APOSTROPHE_ENDS)
    return F.when(quotes == 0, hyphenated(x)).when(quotes == 1, ends & hyphenated(F.substring_index(x, "'", 1))).otherwise(False)


def tiled(c: Column | str, least: Column) -> Column:
    """The text repeated with spaces until it has `least` characters."""
    n = F.greatest(F.lit(1), F.ceil((least + 1) / (F.length(col(c)) + 1)).cast("int"))
    return F.array_join(F.array_repeat(col(c), n), " ")


def hashed(seed: str, *parts: Column | str) -> Column:
    """A number from 0 below 2^32 that stands for a random draw: the same for the same seed and parts, on any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *[col(p).cast("string") for p in parts])), 1, 8), 16, 10).cast("long")
