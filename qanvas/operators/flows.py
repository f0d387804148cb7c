"""Whole flows of multiple-choice items, chained from the operators of `choices`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from . import choices as C


def comma_fallback(completion: Column | str, answer: Column | str, n: int = 3) -> Column:
    """The first n parts between commas that are not the answer in any case; none of a null completion. An answer that has
    commas itself is cut out whole where it stands between commas, so no piece of it is left as a part."""
    own = F.concat(F.lit(r"(?iu)(^|,)\s*\Q"), F.replace(X.strip(answer), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E\s*(?=,|$)"))
    text = F.coalesce(X.col(completion), F.lit(""))
    rest = F.when(F.contains(X.col(answer), F.lit(",")), F.regexp_replace(text, own, "$1")).otherwise(text)
    parts = F.transform(F.split(rest, ","), X.strip)
    return F.slice(F.filter(parts, lambda p: (p != "") & (F.lower(p) != F.lower(X.col(answer)))), 1, n)


def in_order(pool: Column, n: int) -> Column:
    """The stand-in for a choice by energy: the first n of the pool."""
    return F.slice(pool, 1, n)


def distractors(asked: DataFrame, n: int = 3, pool: int = 64, choose: Callable[[Column, int], Column] = in_order) -> DataFrame:
    """qid, answer, pool, distractors of asked (qid, answer, completion, existing, fallback), one row a question.

    The pool is the candidates of the completion's numbered lines, in order, and behind them the existing options that
    are neither the answer nor in it. `choose` takes n of a pool of n or more. Of a smaller pool the fallback's comma
    parts are taken, or, if it has none, all of the pool. Questions without any completion or option have an empty
    pool. Everything is grouped by question, and a question's group is bounded by `pool` and its options."""
    ranked = C.listed_candidates(asked.select("qid", "answer", "completion"), pool).select("qid", F.col("rank").alias("position"), F.col("candidate").alias("word"))
    existing = asked.select("qid", F.posexplode(C.wrong_options("existing", "answer")).alias("position", "word"))
    each = C.with_existing(ranked, existing).groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("existing", "position", "word"))).alias("w"))
    pools = each.select("qid", F.transform("w", lambda w: w["word"]).alias("pool"))
    rows = asked.select("qid", "answer", comma_fallback("fallback", "answer", n).alias("parts")).join(pools, "qid", "left")
    rows = rows.withColumn("pool", F.coalesce("pool", F.array().cast("array<string>")))
    small = F.when(F.size("parts") > 0, F.col("parts")).otherwise(F.col("pool"))
    return rows.select("qid", "answer", "pool", F.when(F.size("pool") >= n, choose(F.col("pool"), n)).otherwise(small).alias("distractors"))


def finished(items: DataFrame, n: int = 3) -> DataFrame:
    """items (qid, answer, distractors) with their final options; an item without distractors has failed, and has the
    answer and n blanks."""
    return items.withColumn("options", C.final_options(F.col("answer"), F.col("distractors"), F.col("qid"), F.size("distractors") == 0, n))


def cloze_test(texts: DataFrame, scores: DataFrame, distract: Callable[[DataFrame], DataFrame], count: int = 3, spacing: int = 4, stopwords: tuple[str, ...] = ()) -> DataFrame:
    """id, cloze, blanks (number, position, options, letter) of texts (id, words) and scores (id, position, score).

    Blanks are up to `count` eligible words of highest score, `spacing` apart, no word twice; `distract` adds three
    distractors to rows (id, position, answer, words); the answer goes into one of four places, which the id and the
    position fix. Texts without an eligible word have their words and no blanks. A text's positions are one group."""
    word = F.col("word")
    found = texts.select("id", F.posexplode("words").alias("position", "word")).where(C.blank_eligible(word, F.col("position"), stopword=F.lower("word").isin(*stopwords)))
    scored = found.join(scores, ["id", "position"])
    # Of equal words only the best may be a blank.
    once = scored.groupBy("id", "word").agg(F.min(F.struct((-F.col("score")).alias("minus"), "position")).alias("b"))
    blanks = C.greedy_blanks(once.select("id", F.col("b.position").alias("position"), (-F.col("b.minus")).alias("score")), count, spacing)
    asked = blanks.join(texts, "id").select("id", "position", F.get("words", F.col("position").cast("int")).alias("answer"), "words")
    options, letter = C.inserted_answer("distractors", "answer", F.concat_ws(":", "id", "position"))
    made = distract(asked).select("id", F.struct("position", options.alias("options"), letter.alias("letter")).alias("b"))
    listed = texts.join(made.groupBy("id").agg(F.array_sort(F.collect_list("b")).alias("b")), "id", "left")
    listed = listed.withColumn("b", F.coalesce("b", F.array().cast(made.select(F.array("b").alias("b")).schema["b"].dataType)))
    return listed.select("id", C.cloze(F.col("words"), F.transform("b", lambda b: b["position"])).alias("cloze"), F.col("b").alias("blanks"))
