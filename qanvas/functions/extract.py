"""Structured records out of generated text: native expressions, one struct column a type, null where text is invalid.

Fields are cut out at their bold labels. Where a pattern would backtrack, labels are located and fields split off
instead, so time is linear in the text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicons import END_MARK, START_MARK
from .text import between_marks, col, lines, once, strip


# The labels that generated text puts before its fields, as patterns, by record type.
SHORT = r"(?s)\*\*Question:\*\*\s*(.*?)\s*\*\*Answer:\*\*\s*(.*)"
SHORT_INVERSE = (
    r"(?s)\*\*Question:\*\*\s*(.*?)\s*\*\*Answer:\*\*\s*(.*?)\s*\*\*Incorrect Answer Explanation:\*\*\s*"
    r"- \*\*False Answer Given:\*\*\s*(.*?)\s*- \*\*Why It Is Incorrect:\*\*\s*(.*)"
)
#: Its fields one by one, where the whole leaves one empty.
SHORT_INVERSE_FIELDS = (
    r"(?s)\*\*Question:\*\*\s*(.*?)\s*\*\*Answer:\*\*", r"(?s)\*\*Answer:\*\*\s*(.*?)\s*\*\*Incorrect Answer Explanation:\*\*",
    r"(?s)- \*\*False Answer Given:\*\*\s*(.*?)\s*- \*\*Why It Is Incorrect:\*\*", r"(?s)- \*\*Why It Is Incorrect:\*\*\s*(.*?)\s*(?:\n|$)",
)
TRUE_FALSE = r"(?is)\*\*Statement:\*\*\s*(.*?)\s*\*\*Answer:\*\*\s*(\bTrue\b|\bFalse\b)"
LISTING = r"(?s)\*\*Question:\*\*\s*(.*?)\s*\*\*Options:\*\*\s*(.*?)\*\*Answer:\*\*\s*(.*)"
CHOICE_QUESTION = (r"(?s)\*\*Question:\*\*\s*(.*?)\s*\*\*Options:\*\*", r"(?s)Question:\s*(.*?)\s*(?:\*\*Options:\*\*|Options:)")
CHOICE_OPTIONS = (r"(?s)\*\*Options:\*\*\s*(.*?)\s*\*\*Answer:\*\*", r"(?s)Options:\s*(.*?)\s*(?:\*\*Answer:\*\*|Answer:)")
CHOICE_ANSWER = (r"\*\*Answer:\*\*\s*([ABCD])", r"Answer:\s*([ABCD])")
MULTI_HOP = r"(?s)\*\*Question:\*\*\s*(.*?)\s*\*\*Answer:\*\*\s*(.*?)\s*\*\*Reasoning:\*\*\s*(.*)"
MULTI_HOP_INVERSE = r"(?s)\*\*Question:\*\*\s*(.*?)\s*\*\*Answer:\*\*\s*(.*?)\s*\*\*Reasoning:\*\*\s*(.*?)\s*\*\*Incorrect Reasoning Step:\*\*\s*(.*)"


def body(c: Column | str, occurrence: int = 1) -> Column:
    return between_marks(c, START_MARK, END_MARK, occurrence)


def _group(x: Column, pattern: str, i: int = 1) -> Column:
    """A group, or null where the pattern does not match."""
    return F.when(x.rlike(pattern), F.regexp_extract(x, pattern, i))


def _filled(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def _record(valid: Column, **fields: Column) -> Column:
    return F.when(F.coalesce(valid, F.lit(False)), F.struct(*[c.alias(k) for k, c in fields.items()]))


def short(c: Column | str) -> Column:
    x = col(c)
    answer = strip(F.element_at(F.split(strip(_group(x, SHORT, 2)), r"\n|\s{2,}"), 1))
    return _record(x.rlike(SHORT), question=strip(_group(x, SHORT, 1)), answer=answer)


def short_inverse(c: Column | str) -> Column:
    x = col(c)
    names = ("question", "answer", "false_answer", "incorrect_explanation")
    fields = {n: _filled(strip(_group(x, SHORT_INVERSE, i + 1)), strip(_group(x, SHORT_INVERSE_FIELDS[i]))) for i, n in enumerate(names)}
    valid = x.rlike(SHORT_INVERSE)
    for f in fields.values():
        valid = valid & f.isNotNull()
    return _record(valid, **fields)


def true_false(c: Column | str) -> Column:
    x = col(c)
    return _record(x.rlike(TRUE_FALSE), question=strip(_group(x, TRUE_FALSE, 1)), answer=F.initcap(F.lower(_group(x, TRUE_FALSE, 2))))


def bullets(block: Column) -> Column:
    """Items of a bullet block: lines without dashes and spaces at both ends; none if it does not begin with a bullet."""
    items = F.transform(lines(block), lambda line: F.regexp_replace(line, r"^[- ]+|[- ]+$", ""))
    return F.when(block.rlike(r"^- ."), items).otherwise(F.array().cast("array<string>"))


def listing(c: Column | str) -> Column:
    x, pattern = col(c), LISTING
    options, answers = bullets(_group(x, pattern, 2)), bullets(_group(x, pattern, 3))
    return _record(x.rlike(pattern) & (F.size(options) > 0) & (F.size(answers) > 0), question=strip(_group(x, pattern, 1)), options=options, answer=answers)


def multiple_choice(c: Column | str, anchored: bool = True) -> Column:
    """Question, options A to D, letter of the right one. Options are found at line starts; anchored=False takes any
    letter A to D for a label, as older files were read."""
    x = col(c)
    first = lambda patterns: F.coalesce(*[_group(x, p) for p in patterns])
    question, block, letter = first(CHOICE_QUESTION), strip(first(CHOICE_OPTIONS)), first(CHOICE_ANSWER)
    at, mark = ("(?:^|\\n)\\s*", "[:.]") if anchored else ("", "[:.]?")
    next_ = {"A": "B", "B": "C", "C": "D"}

    def options(b: Column) -> Column:
        """Three ways to read the block, each an array; the first that has all four options."""
        found = F.array(*[strip(_group(b, rf"(?s){at}{k}{mark}\s*(.*?)\s*" + (rf"\n\s*{next_[k]}{mark}" if k in next_ else r"$"))) for k in "ABCD"])
        by_line = F.array(*[strip(_group(b, rf"(?m)^\s*{k}[:.](.*)$")) for k in "ABCD"])
        by_place = F.transform(F.slice(lines(b), 1, 4), lambda r: strip(F.substr(r, F.lit(3))))
        return F.get(F.filter(F.array(found, by_line, by_place), lambda o: (F.size(o) == 4) & F.forall(o, lambda v: v.isNotNull())), F.lit(0))

    fields = F.struct(strip(question).alias("question"), once(block, options).alias("options"), letter.alias("letter"))
    return once(fields, lambda f: _record(
        f["question"].isNotNull() & f["options"].isNotNull() & f["letter"].isNotNull(), question=f["question"],
        **{f"option_{k.lower()}": F.get(f["options"], F.lit(i)) for i, k in enumerate("ABCD")}, correct_answer=f["letter"],
    ))


def _plain(c: Column) -> Column:
    return F.replace(strip(c), F.lit("**"), F.lit(""))


def multi_hop(c: Column | str) -> Column:
    x, pattern = col(c), MULTI_HOP
    question, answer, reasoning = (_plain(_group(x, pattern, i)) for i in (1, 2, 3))
    return _record((question != "") & (answer != "") & (reasoning != ""), question=question, answer=answer, reasoning=lines(reasoning))


def multi_hop_inverse(c: Column | str) -> Column:
    x = col(c)
    pattern = MULTI_HOP_INVERSE
    question, answer, reasoning, wrong = (_plain(_group(x, pattern, i)) for i in (1, 2, 3, 4))
    valid = (question != "") & (answer != "") & (F.size(lines(reasoning)) > 0) & (F.size(lines(wrong)) > 0)
    return _record(valid, question=question, answer=answer, reasoning=lines(reasoning), incorrect_reasoning_step=lines(wrong))


def _around(x: Column, label: str) -> tuple[Column, Column]:
    """What stands before and behind the first label, stripped; null without the label."""
    parts = F.split(x, f"\\Q{label}\\E", 2)
    return strip(F.get(parts, F.lit(0))), strip(F.get(parts, F.lit(1)))


def plain_short(c: Column | str) -> Column:
    question, answer = _around(col(c), "\nAnswer:")
    return _record(answer.isNotNull(), question=question, answer=answer)


def plain_true_false(c: Column | str) -> Column:
    question, answer = _around(col(c), "\nAnswer:")
    return _record(answer.isin("True", "False"), question=question, answer=answer)


def plain_listing(c: Column | str) -> Column:
    question, answer = _around(col(c), "\nAnswer:")
    return _record(answer.rlike("[•,;\n]"), question=question, answer=answer)


def plain_multi_hop(c: Column | str) -> Column:
    question, rest = _around(col(c), "\nAnswer:")
    answer, reasoning = F.get(F.split(rest, "\nReasoning:|^Reasoning:", 2), F.lit(0)), F.get(F.split(rest, "\nReasoning:|^Reasoning:", 2), F.lit(1))
    return _record(reasoning.isNotNull(), question=question, answer=strip(answer), reasoning=strip(reasoning))


def plain_multiple_choice(c: Column | str) -> Column:
    """Options after line-initial A: to D:; the last one tagged [Correct] is the answer."""
    x = col(c)
    parts = F.split(x, r"\n[ABCD]:")
    tagged = {k: F.get(parts, F.lit(i + 1)) for i, k in enumerate("ABCD")}
    right = F.lit(None).cast("string")
    for k, v in tagged.items():
        right = F.when(F.contains(v, F.lit("[Correct]")), F.lit(k)).otherwise(right)
    options = {f"option_{k.lower()}": strip(F.replace(v, F.lit("[Correct]"), F.lit(""))) for k, v in tagged.items()}
    return _record((F.size(parts) >= 5) & right.isNotNull(), question=strip(F.get(parts, F.lit(0))), **options, correct_answer=right)


PARSERS = {"short": short, "short_inverse": short_inverse, "tf": true_false, "list": listing, "mc": multiple_choice, "multi_hop": multi_hop, "multi_hop_inverse": multi_hop_inverse}
PLAIN_PARSERS = {"short": plain_short, "tf": plain_true_false, "list": plain_listing, "mc": plain_multiple_choice, "multi_hop": plain_multi_hop}
