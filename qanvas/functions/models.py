"""Model interfaces: annotators, embedders, generators, scorers. What needs a model is given as a function; the
defaults are deterministic stand-ins in native expressions, so plans and tests run without any model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import col, sentences, word_count


def pattern_labels(c: Column | str) -> Column:
    """Stand-in for entity labels: a label for each pattern that occurs."""
    x = col(c)
    rules = {"DATE": r"[0-9]{4}", "PERSON": r"[A-Z][a-z]+ [A-Z][a-z]+", "ORG": r"[A-Z]{2,}", "GPE": r"[a-z] [A-Z][a-z]+ [a-z]"}
    return F.filter(F.array(*[F.when(x.rlike(p), F.lit(k)) for k, p in rules.items()]), lambda v: v.isNotNull())


def length_entropy(c: Column | str) -> Column:
    """Stand-in for the variance of sentence embeddings."""
    return F.length(col(c)) % 100 / 100.0


def annotated(rows: DataFrame, text: str = "text", annotate: Callable[[pd.Series], pd.DataFrame] | None = None) -> DataFrame:
    """rows with n_sentences, labels, entropy. `annotate` maps a series of texts to these three columns and runs once a
    batch, where a model is loaded once a worker; without it the stand-ins are used."""
    if annotate is None:
        return rows.withColumns({"n_sentences": F.size(sentences(text)), "labels": pattern_labels(text), "entropy": length_entropy(text)})
    udf = F.pandas_udf(annotate, "n_sentences int, labels array<string>, entropy double")
    return rows.withColumn("__a", udf(text)).select(*rows.columns, "__a.*")


def embedded(rows: DataFrame, text: str, embed: Callable[[pd.Series], pd.Series]) -> DataFrame:
    return rows.withColumn("embedding", F.pandas_udf(embed, "array<float>")(text))


def generated(rows: DataFrame, prompt: str, load: Callable[[], Callable[[list[str]], list[str]]]) -> DataFrame:
    """rows with completion. `load` is called once a task and gives a function from prompts to completions."""
    schema = rows.schema.simpleString()[len("struct<") : -1] + ",completion:string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generate = load()
        for pdf in batches:
            yield pdf.assign(completion=generate(pdf[prompt].tolist()))

    return rows.mapInPandas(run, schema)


def token_budget(n_tokens: Column, max_sequence: int, max_new: int) -> tuple[Column, Column]:
    """Input length after truncation, and what is left for new tokens (may be 0)."""
    used = F.least(n_tokens, F.lit(max_sequence))
    return used, F.least(F.lit(max_new), F.lit(max_sequence) - used)


def estimated_tokens(c: Column | str) -> Column:
    """Stand-in for a tokenizer: words."""
    return word_count(c)
