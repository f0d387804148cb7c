"""Queries of structured extraction, over completions made from benchmark items (every fourth one is malformed)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import extract as E
from ..functions import lexicons as L
from .base import query, sql_lines, sql_strip, table

#: Bodies of completions: the item's text stands at {t}. They are Spark and DuckDB format-free: {t} is replaced as text.
BODIES = {
    "short": "**Question:** What of {t}?\n**Answer:** one two  three\nfour",
    "short_inverse": "**Question:** Q {t}\n**Answer:** A {t}\n**Incorrect Answer Explanation:**\n- **False Answer Given:** F {t}\n- **Why It Is Incorrect:** because {t}",
    "tf": "**Statement:** {t}\n**Answer:** FALSE.",
    "list": "**Question:** List {t}\n**Options:**\n- b-c\n- -x\n- {t}\n**Answer:**\n- b-c\n- {t}",
    "mc": "**Question:** Which {t}\n**Options:**\nA: Vitamin D\nB: heparin\nC. {t}\nD: insulin\n**Answer:** B",
    "multi_hop": "**Question:** **Why** {t}\n**Answer:** {t}\n**Reasoning:** first\n\n  second {t}",
    "multi_hop_inverse": "**Question:** Why {t}\n**Answer:** {t}\n**Reasoning:** first\nsecond\n**Incorrect Reasoning Step:** wrong {t}\n\nend",
    "plain_short": "What {t}\nAnswer: {t}",
    "plain_tf": "Is {t}\nAnswer: True",
    "plain_list": "List {t}\nAnswer: a; b",
    "plain_multi_hop": "Why {t}\nAnswer: so\nReasoning: since {t}",
    "plain_mc": "Which {t}\nA: one\nB: two [Correct]\nC: {t}\nD: four",
}


def completions(spark, sf_dir, kind: str):
    """item_id, body: what stands between the marks of a completion."""
    filled = F.replace(F.lit(BODIES[kind]), F.lit("{t}"), F.col("text"))
    broken = F.when(F.col("item_id") % 4 == 3, F.replace(F.replace(filled, F.lit("**Answer:**"), F.lit("Answer")), F.lit("\nAnswer:"), F.lit(" "))).otherwise(filled)
    rows = table(spark, sf_dir, "benchmark").select("item_id", F.concat(F.lit("x " + L.START_MARK + " "), broken, F.lit(" " + L.END_MARK + " y")).alias("completion"))
    return rows.select("item_id", E.body("completion").alias("body"))


def sql_completions(kind: str) -> str:
    body = " || chr(10) || ".join("'" + line.replace("'", "''") + "'" for line in BODIES[kind].split("\n"))
    filled = f"replace({body}, '{{t}}', text)"
    broken = f"replace(replace({filled}, '**Answer:**', 'Answer'), chr(10) || 'Answer:', ' ')"
    return f"c AS (SELECT item_id, {sql_strip(f'CASE WHEN item_id % 4 = 3 THEN {broken} ELSE {filled} END')} AS body FROM benchmark)"


def _pattern(*parts: str) -> str:
    return "(?s)" + r"\s*".join(parts)


_Q, _A = r"\*\*Question:\*\*", r"\*\*Answer:\*\*"
_FIELD, _REST = r"(.*?)", r"(.*)"


def _group(pattern: str, i: int) -> str:
    return sql_strip(f"regexp_extract(body, '{pattern}', {i})")


def _extracted(kind: str, parser) -> object:
    def run(spark, sf_dir):
        rows = completions(spark, sf_dir, kind)
        return rows.select("item_id", parser("body").alias("r")).where("r IS NOT NULL").select("item_id", "r.*")

    run.__name__ = f"extract_{kind}"
    return run


_SHORT = _pattern(_Q, _FIELD, _A, _REST)
query(f"""WITH {sql_completions("short")} SELECT item_id, {_group(_SHORT, 1)} AS question,
 {sql_strip(f"regexp_split_to_array({_group(_SHORT, 2)}, '\\n|\\s{{2,}}')[1]")} AS answer FROM c WHERE regexp_matches(body, '{_SHORT}')""")(_extracted("short", E.short))

_INVERSE = _pattern(_Q, _FIELD, _A, _FIELD, r"\*\*Incorrect Answer Explanation:\*\*", r"- \*\*False Answer Given:\*\*", _FIELD, r"- \*\*Why It Is Incorrect:\*\*", _REST)
query(f"""WITH {sql_completions("short_inverse")} SELECT * FROM (SELECT item_id, {_group(_INVERSE, 1)} AS question, {_group(_INVERSE, 2)} AS answer, {_group(_INVERSE, 3)} AS false_answer,
 {_group(_INVERSE, 4)} AS incorrect_explanation FROM c WHERE regexp_matches(body, '{_INVERSE}')) WHERE question <> '' AND answer <> '' AND false_answer <> '' AND incorrect_explanation <> ''""")(_extracted("short_inverse", E.short_inverse))

_TF = r"(?is)\*\*Statement:\*\*\s*(.*?)\s*\*\*Answer:\*\*\s*(\bTrue\b|\bFalse\b)"
query(f"""WITH {sql_completions("tf")} SELECT item_id, {_group(_TF, 1)} AS question, CASE lower({_group(_TF, 2)}) WHEN 'true' THEN 'True' ELSE 'False' END AS answer
FROM c WHERE regexp_matches(body, '{_TF}')""")(_extracted("tf", E.true_false))

_LIST = _pattern(_Q, _FIELD, r"\*\*Options:\*\*", r"(.*?)" + _A, _REST)


def _sql_bullets(i: int) -> str:
    lines = sql_lines(f"regexp_extract(body, '{_LIST}', {i})")
    return f"list_transform({lines}, lambda s: regexp_replace(s, '^[- ]+|[- ]+$', '', 'g'))"


query(f"""WITH {sql_completions("list")} SELECT item_id, {_group(_LIST, 1)} AS question, {_sql_bullets(2)} AS options, {_sql_bullets(3)} AS answer
FROM c WHERE regexp_matches(body, '{_LIST}') AND regexp_matches(regexp_extract(body, '{_LIST}', 2), '^- .') AND regexp_matches(regexp_extract(body, '{_LIST}', 3), '^- .')""")(_extracted("list", E.listing))

_MC = r"(?s)\*\*Question:\*\*\s*(.*?)\s*\*\*Options:\*\*\s*A[:.]\s*(.*?)\s*\n\s*B[:.]\s*(.*?)\s*\n\s*C[:.]\s*(.*?)\s*\n\s*D[:.]\s*(.*?)\s*\*\*Answer:\*\*\s*([ABCD])"
query(f"""WITH {sql_completions("mc")} SELECT item_id, {_group(_MC, 1)} AS question, {_group(_MC, 2)} AS option_a, {_group(_MC, 3)} AS option_b, {_group(_MC, 4)} AS option_c, {_group(_MC, 5)} AS option_d,
 {_group(_MC, 6)} AS correct_answer FROM c WHERE regexp_matches(body, '{_MC}')""")(_extracted("mc", E.multiple_choice))

_HOP = _pattern(_Q, _FIELD, _A, _FIELD, r"\*\*Reasoning:\*\*", _REST)
_plain = lambda p, i: f"replace({_group(p, i)}, '**', '')"
query(f"""WITH {sql_completions("multi_hop")} SELECT item_id, {_plain(_HOP, 1)} AS question, {_plain(_HOP, 2)} AS answer, {sql_lines(_plain(_HOP, 3))} AS reasoning
FROM c WHERE regexp_matches(body, '{_HOP}')""")(_extracted("multi_hop", E.multi_hop))

_HOP_INVERSE = _pattern(_Q, _FIELD, _A, _FIELD, r"\*\*Reasoning:\*\*", _FIELD, r"\*\*Incorrect Reasoning Step:\*\*", _REST)
query(f"""WITH {sql_completions("multi_hop_inverse")} SELECT item_id, {_plain(_HOP_INVERSE, 1)} AS question, {_plain(_HOP_INVERSE, 2)} AS answer, {sql_lines(_plain(_HOP_INVERSE, 3))} AS reasoning,
 {sql_lines(_plain(_HOP_INVERSE, 4))} AS incorrect_reasoning_step FROM c WHERE regexp_matches(body, '{_HOP_INVERSE}')""")(_extracted("multi_hop_inverse", E.multi_hop_inverse))

_AT = "strpos(body, chr(10) || 'Answer:')"
_BEFORE, _BEHIND = sql_strip(f"substr(body, 1, {_AT} - 1)"), sql_strip(f"substr(body, {_AT} + 8)")
query(f"WITH {sql_completions('plain_short')} SELECT item_id, {_BEFORE} AS question, {_BEHIND} AS answer FROM c WHERE {_AT} > 0")(_extracted("plain_short", E.plain_short))
query(f"WITH {sql_completions('plain_tf')} SELECT item_id, {_BEFORE} AS question, {_BEHIND} AS answer FROM c WHERE {_AT} > 0 AND {_BEHIND} IN ('True', 'False')")(_extracted("plain_tf", E.plain_true_false))
query(f"WITH {sql_completions('plain_list')} SELECT item_id, {_BEFORE} AS question, {_BEHIND} AS answer FROM c WHERE {_AT} > 0 AND regexp_matches({_BEHIND}, '[•,;\\n]')")(_extracted("plain_list", E.plain_listing))
_WHY = f"strpos({_BEHIND}, chr(10) || 'Reasoning:')"
query(f"""WITH {sql_completions("plain_multi_hop")} SELECT item_id, {_BEFORE} AS question, {sql_strip(f"substr({_BEHIND}, 1, {_WHY} - 1)")} AS answer, {sql_strip(f"substr({_BEHIND}, {_WHY} + 11)")} AS reasoning
FROM c WHERE {_AT} > 0 AND {_WHY} > 0""")(_extracted("plain_multi_hop", E.plain_multi_hop))
_PLAIN_MC = r"(?s)^(.*?)\nA:(.*?)\nB:(.*?)\nC:(.*?)\nD:(.*)$"
_option = lambda i: sql_strip(f"replace(regexp_extract(body, '{_PLAIN_MC}', {i}), '[Correct]', '')")
query(f"""WITH {sql_completions("plain_mc")} SELECT item_id, {_group(_PLAIN_MC, 1)} AS question, {_option(2)} AS option_a, {_option(3)} AS option_b, {_option(4)} AS option_c, {_option(5)} AS option_d, 'B' AS correct_answer
FROM c WHERE regexp_matches(body, '{_PLAIN_MC}')""")(_extracted("plain_mc", E.plain_multiple_choice))


@query(f"""WITH b AS (SELECT item_id, text || '{L.START_MARK} one ' || item_id || ' {L.END_MARK} mid {L.START_MARK}two{L.END_MARK}' AS x FROM benchmark)
SELECT item_id, 'one ' || item_id AS first, 'two' AS second, CAST(NULL AS VARCHAR) AS third FROM b""")
def marker_extract(spark, sf_dir):
    x = F.concat("text", F.lit(L.START_MARK + " one "), F.col("item_id").cast("string"), F.lit(f" {L.END_MARK} mid {L.START_MARK}two{L.END_MARK}"))
    rows = table(spark, sf_dir, "benchmark").select("item_id", x.alias("x"))
    return rows.select("item_id", *[E.body("x", i).alias(n) for i, n in ((1, "first"), (2, "second"), (3, "third"))])


@query()
def extract_mc_unanchored(spark, sf_dir):
    """Options as older files were read: any letter A to D may begin one. RE2 and Java differ in such patterns, so rows only."""
    return completions(spark, sf_dir, "mc").select("item_id", E.multiple_choice("body", anchored=False).alias("r")).where("r IS NOT NULL").select("item_id", "r.*")
