"""Where queries and their SQL oracles are registered, and SQL fragments that several oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions import stem as P

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function as the query of its name, with its oracle."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def sql_words(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '\s+'), lambda w: w <> '')"


def sql_sentence_parts(x: str) -> str:
    return rf"string_split(regexp_replace({x}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))"


def sql_sentences(x: str) -> str:
    return f"list_filter(list_transform({sql_sentence_parts(x)}, lambda s: {sql_strip('s')}), lambda s: s <> '')"


def sql_lines(x: str) -> str:
    return f"list_filter(list_transform(string_split({x}, chr(10)), lambda s: {sql_strip('s')}), lambda s: s <> '')"


def sql_any(lowered: str, keywords: list[str]) -> str:
    return "(" + " OR ".join(f"contains({lowered}, '{k}')" for k in keywords) + ")"


def sql_hash(seed: str, *parts: str) -> str:
    joined = " || '|' || ".join([f"'{seed}'", *[f"CAST({p} AS VARCHAR)" for p in parts]])
    return f"CAST(('0x' || substr(md5({joined}), 1, 8)) AS BIGINT)"


def sql_cosine(a: str, b: str) -> str:
    dot = lambda x, y: f"list_sum(list_transform(range(1, len({x}) + 1), lambda k: CAST({x}[k] AS DOUBLE) * CAST({y}[k] AS DOUBLE)))"
    return f"(CASE WHEN sqrt({dot(a, a)}) * sqrt({dot(b, b)}) = 0 THEN 1.0 ELSE {dot(a, b)} / (sqrt({dot(a, a)}) * sqrt({dot(b, b)})) END)"


def _sql_less(n: int, x: str = "x") -> str:
    return f"left({x}, greatest(length({x}) - {n}, 0))"


def _sql_rule(endings: list[tuple[str, str]]) -> str:
    cases = " ".join(f"WHEN ends_with(x, '{e}') THEN CASE WHEN regexp_matches({_sql_less(len(e) - (e == 'logi'))}, '{P.OVER_0}') THEN {_sql_less(len(e))} || '{by}' ELSE x END" for e, by in endings)
    return f"CASE {cases} ELSE x END"


_FOUR = "length(x) = 4"


def _sql_mended(x: str) -> str:
    double = f"(length({x}) > 1 AND right({x}, 1) = left(right({x}, 2), 1) AND regexp_matches({x}, '[^aeiou]$'))"
    return f"""CASE WHEN regexp_matches({x}, '(at|bl|iz)$') OR (NOT {double} AND regexp_matches({x}, '{P.IS_1}') AND regexp_matches({x}, '{P.SHORT_END}')) THEN {x} || 'e'
 WHEN {double} AND NOT regexp_matches({x}, '[lsz]$') THEN {_sql_less(1, x)} ELSE {x} END"""


_DROP = " ".join(
    f"WHEN ends_with(x, '{e}') THEN CASE WHEN regexp_matches({_sql_less(len(e))}, '{P.OVER_1}')" + (f" AND regexp_matches({_sql_less(3)}, '[st]$')" if e == "ion" else "") + f" THEN {_sql_less(len(e))} ELSE x END" for e in P.STEP_4
)
#: Steps, each from the x of the one before; a `!` marks what has lost -ed or -ing.
_STEPS = [
    f"CASE WHEN ends_with(x, 'ies') AND {_FOUR} THEN {_sql_less(1)} WHEN ends_with(x, 'sses') OR ends_with(x, 'ies') THEN {_sql_less(2)} WHEN ends_with(x, 'ss') THEN x WHEN ends_with(x, 's') THEN {_sql_less(1)} ELSE x END",
    f"""CASE WHEN ends_with(x, 'ied') THEN CASE WHEN {_FOUR} THEN {_sql_less(1)} ELSE {_sql_less(2)} END WHEN ends_with(x, 'eed') THEN CASE WHEN regexp_matches({_sql_less(3)}, '{P.OVER_0}') THEN {_sql_less(1)} ELSE x END
 WHEN ends_with(x, 'ed') AND regexp_matches({_sql_less(2)}, '{P.HAS_VOWEL}') THEN {_sql_less(2)} || '!' WHEN ends_with(x, 'ing') AND regexp_matches({_sql_less(3)}, '{P.HAS_VOWEL}') THEN {_sql_less(3)} || '!' ELSE x END""",
    f"CASE WHEN NOT ends_with(x, '!') THEN x ELSE {_sql_mended(_sql_less(1))} END",
    f"CASE WHEN ends_with(x, 'y') AND length(x) > 2 AND regexp_matches({_sql_less(1)}, '[^aeiouy]$') THEN {_sql_less(1)} || 'i' ELSE x END",
    f"CASE WHEN ends_with(x, 'alli') AND regexp_matches({_sql_less(4)}, '{P.OVER_0}') THEN {_sql_less(2)} ELSE x END",
    _sql_rule(P.STEP_2),
    _sql_rule(P.STEP_3),
    f"CASE {_DROP} ELSE x END",
    f"CASE WHEN ends_with(x, 'e') AND (regexp_matches({_sql_less(1)}, '{P.OVER_1}') OR (regexp_matches({_sql_less(1)}, '{P.IS_1}') AND NOT regexp_matches({_sql_less(1)}, '{P.SHORT_END}'))) THEN {_sql_less(1)} ELSE x END",
    f"CASE WHEN ends_with(x, 'll') AND regexp_matches({_sql_less(1)}, '{P.OVER_1}') THEN {_sql_less(1)} ELSE x END",
]


def sql_stems(words: str, name: str = "stems") -> str:
    """CTEs that end in `name` (word, stem) of the words that a query gives as column word."""
    out = [f"{name}_0 AS (SELECT word, lower(word) AS w, CASE WHEN left(lower(word), 1) = 'y' THEN 'Y' || substr(lower(word), 2) ELSE lower(word) END AS x FROM ({words}))"]
    for i, step in enumerate(_STEPS, 1):
        out.append(f"{name}_{i} AS (SELECT word, w, {step} AS x FROM {name}_{i - 1})")
    known = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in P.IRREGULAR.items())
    out.append(f"{name} AS (SELECT word, CASE WHEN length(w) <= 2 THEN w ELSE CASE w {known} ELSE lower(x) END END AS stem FROM {name}_{len(_STEPS)})")
    return ", ".join(out)
