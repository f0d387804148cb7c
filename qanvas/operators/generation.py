"""The generation flow: gate, score, balanced type, prompt, completion, parse by type, append. As a batch and as a stream."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import extract as E
from ..functions import models as M
from ..functions import text as X
from . import questions as Q

#: What a paragraph brings along, beside its scores.
PARAGRAPH = ["isbn", "paragraph_id", "page", "position", "text"]
#: What is saved of a question: its type and book name the file, the record is canonical JSON.
SAVED = "type string, isbn string, record string"

Generate = Callable[[DataFrame], DataFrame]


def scored_paragraphs(paragraphs: DataFrame, annotate=None) -> DataFrame:
    """The informative ones of paragraphs (PARAGRAPH), with their score for each type and the two draws of the balance,
    which book and position fix."""
    kept = paragraphs.select(*PARAGRAPH).where(Q.length_gate("text") & Q.keyword_gate("text"))
    rows = M.annotated(kept, annotate=annotate).withColumn("low", F.lower("text"))
    scores = Q.type_scores("text", F.col("n_sentences"), F.col("labels"), F.col("entropy"), low=F.col("low"))
    draws = {k: X.hashed(k, "isbn", "position") for k in ("draw", "flip")}
    return rows.select(*PARAGRAPH, *[s.cast("double").alias(f"score_{t}") for t, s in scores.items()], *[c.alias(k) for k, c in draws.items()])


def key_of() -> Column:
    """What a paragraph is known by while its text is elsewhere: a digest of its book, position and text."""
    return F.md5(F.to_json(F.struct("isbn", "position", "text")))


def without_texts(scored: DataFrame) -> DataFrame:
    """Scored paragraphs with key instead of text: the balance is a fold of small rows, and a book's go through one task."""
    return scored.withColumn("key", key_of()).drop("text")


def with_texts(assigned: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Assigned paragraphs without_texts, with their texts from all paragraphs."""
    texts = paragraphs.select(key_of().alias("key"), "text").dropDuplicates(["key"])
    return assigned.join(texts, "key").drop("key")


def parsed(kind: Column | str, completion: Column | str, source: Column | str) -> Column:
    """The record in a completion, by the parser of its type, with its source, as JSON with sorted fields; null where the
    completion has no such record or the type is unknown. Only the parser of a row's own type is run, once."""

    def record(t: str, body: Column) -> Column:
        names = sorted([*_fields(t), "source"])
        return X.once(E.PARSERS[t](body), lambda r: F.when(r.isNotNull(), F.to_json(F.struct(*[(X.col(source) if n == "source" else r[n]).alias(n) for n in names]))))

    def dispatched(body: Column) -> Column:
        out = F.when(F.lit(False), F.lit(None).cast("string"))
        for t in E.PARSERS:
            out = out.when(X.col(kind) == t, X.once(body, partial(record, t)))
        return out

    return X.once(E.body(completion), dispatched)


def _fields(kind: str) -> list[str]:
    """Field names of a type's records. The saved files have them."""
    return {
        "short": ["question", "answer"], "short_inverse": ["question", "answer", "false_answer", "incorrect_explanation"], "tf": ["question", "answer"], "list": ["question", "options", "answer"],
        "mc": ["question", "option_a", "option_b", "option_c", "option_d", "correct_answer"], "multi_hop": ["question", "answer", "reasoning"],
        "multi_hop_inverse": ["question", "answer", "reasoning", "incorrect_reasoning_step"],
    }[kind]


def asked(assigned: DataFrame, templates: DataFrame, generate: Generate) -> DataFrame:
    """SAVED of assigned paragraphs (PARAGRAPH and assigned): prompts by template, completions by `generate` (rows with
    type, prompt and PARAGRAPH get completion), records by type. Rows without a template or a record go."""
    rows = generate(Q.rendered(assigned.withColumnRenamed("assigned", "type"), templates))
    record = parsed("type", "completion", Q.source_of("isbn", "page", "paragraph_id"))
    return rows.select("type", "isbn", record.alias("record")).where("record IS NOT NULL")


def generated(paragraphs: DataFrame, templates: DataFrame, generate: Generate, annotate=None, threshold: int = 10) -> DataFrame:
    """SAVED of all paragraphs, a fold of the balance for each book, distinct: what a stream over them comes to."""
    folded = Q.balanced(without_texts(scored_paragraphs(paragraphs, annotate)), ["isbn"], ["position"], threshold)
    return asked(with_texts(folded, paragraphs), templates, generate).distinct()
