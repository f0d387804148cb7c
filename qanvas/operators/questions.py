"""Quality gates, question types and balanced assignment."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import text as X
from ..session import shared_folder


def length_gate(c: Column | str, least_words: int = 15, least_sentences: int = 2) -> Column:
    return (X.word_count(c) >= least_words) & (F.size(X.sentences(c)) >= least_sentences)


def keyword_gate(c: Column | str) -> Column:
    """Front and back matter goes. Keywords are compared with lowered text as they are."""
    return ~X.contains_any(X.col(c), L.IRRELEVANT)


def figure_gate(c: Column | str) -> Column:
    """Off by default, as where it comes from."""
    return ~X.col(c).rlike(r"(\d+\.\d+|Fig\.|Table|•)")


def density_gate(n_entities: Column, n_words: Column, least: float = 0.01) -> Column:
    return F.coalesce(F.try_divide(n_entities, n_words) >= least, F.lit(True))


def coherence_gate(variance: Column, most: float = 0.5) -> Column:
    """A failed measure keeps the paragraph."""
    return F.coalesce(variance <= most, F.lit(True))


def reject_reason(c: Column | str, labels: Column | None = None, variance: Column | None = None, figures: bool = False) -> Column:
    """The first gate that rejects, cheap ones first; null for what is kept."""
    out = F.when(~length_gate(c), "length").when(~keyword_gate(c), "keyword")
    if figures:
        out = out.when(~figure_gate(c), "figure")
    if labels is not None:
        out = out.when(~density_gate(F.size(labels), X.word_count(c)), "density")
    if variance is not None:
        out = out.when(~coherence_gate(variance), "coherence")
    return out


def _points(*rules: tuple[Column, int]) -> Column:
    out = F.lit(0)
    for condition, n in rules:
        out = out + F.when(F.coalesce(condition, F.lit(False)), n).otherwise(0)
    return out


def type_scores(c: Column | str, n_sentences: Column, labels: Column, entropy: Column, n_nouns: Column | None = None, choice_points: tuple[int, int, int, int] = (2, 4, 2, 3), low: Column | None = None) -> dict[str, Column]:
    """Additive rule scores by type. `low`: the lowered text, if a column has it, so that it is made once for all lists. choice_points: of keyword, labelled options, many labels, "which of the following"
    (the older weights are 1, 3, 1, 2). Two distinct labels or more are what makes more than one label pair."""
    x = X.col(c)
    has = lambda words: X.contains_any(x, words) if low is None else X.has_any(low, words)
    lowered = F.lower(x) if low is None else low
    distinct = F.size(F.array_distinct(labels))
    k, o, m, w = choice_points
    short = _points((has(L.SHORT_WORDS), 1), ((entropy >= 0.3) & (entropy <= 0.5), 1), ((distinct >= 1) & (n_sentences > 1), 1), (x.endswith("?"), 2))
    hop = _points((has(L.REASON_WORDS), 1), ((distinct > 3) & (n_sentences > 3), 2), (distinct > 1, 2), (entropy > 0.5, 1))
    return {
        "short": short,
        "tf": _points((has(L.TRUTH_WORDS), 1), (n_sentences <= 2, 2), (distinct == 0, 1), (entropy < 0.3, 1)),
        "list": _points((has(L.LIST_WORDS), 1), (x.rlike("[,;]"), 2), (distinct > 2, 1), ((n_nouns if n_nouns is not None else F.lit(0)) > 5, 1)),
        "mc": _points((has(L.CHOICE_WORDS), k), (x.rlike("[ABCD]:"), o), ((n_sentences > 1) & (distinct > 1), m), (F.contains(lowered, F.lit("which of the following")), w)),
        "multi_hop": hop,
        "short_inverse": short,
        "multi_hop_inverse": hop,
    }


def best_type(scores: dict[str, Column]) -> Column:
    """The type of highest score; ties go to the first in the fixed order."""
    ranked = F.array(*[F.struct(scores[t].alias("score"), F.lit(-i).alias("order"), F.lit(t).alias("type")) for i, t in enumerate(L.TYPES) if t in scores])
    return F.array_max(ranked)["type"]


def first_type(c: Column | str) -> Column:
    """The oldest rule: a cascade. Words, their edges and the cases of letters are those of the SQL: white space without
    the vertical tab, edges between letters of ASCII and anything else, cases of all letters."""
    x = X.col(c)
    n_words = F.size(F.filter(F.split(x, r"[ \t\n\f\r]+"), lambda w: w != ""))
    edged = r"(?<![0-9A-Za-z_])(\d{4}|\d{1,2}/\d{1,2}/\d{2,4}|[A-Z][a-z]+ [A-Z][a-z]+)(?![0-9A-Za-z_])"
    return F.when(x.rlike("•|,|;|and|or") & (n_words > 15), "list").when(x.rlike(f"(?iu)({L.V1_CHOICE})"), "mc").when(x.rlike(edged), "short").otherwise("tf")


def second_scores(c: Column | str, n_sentences: Column, labels: Column, entropy: Column) -> dict[str, Column]:
    x, distinct = X.col(c), F.size(F.array_distinct(labels))
    return {
        "short": _points((F.arrays_overlap(labels, F.array(*map(F.lit, L.NAMED_LABELS))), 2), ((entropy >= 0.3) & (entropy <= 0.5), 1)),
        "tf": _points((entropy < 0.3, 1), (n_sentences <= 2, 1), (distinct == 0, 1)),
        "list": _points((entropy > 0.5, 1), (distinct > 2, 1), (x.rlike("•|,|;|and|or"), 1)),
        "mc": _points((x.rlike(f"(?i)({L.V2_CHOICE})"), 2), ((n_sentences > 1) & (distinct > 1), 1), (x.rlike("[ABCD]:"), 2)),
        "multi_hop": _points((x.rlike(f"(?i)({L.V2_REASON})"), 2), ((distinct > 3) & (n_sentences > 3), 1), (distinct > 1, 1)),
    }


class Balance:
    """Balanced assignment, one row after another: counts by category discount the scores; categories that lag by the
    threshold are drawn from first; short and multi-hop flip to their inverse half the time. Draws are two 32-bit numbers
    that come with a row, so any engine gets the same result."""

    def __init__(self, counts: dict[str, int] | None = None, threshold: int = 10) -> None:
        self.counts, self.threshold = {c: 0 for c in L.CATEGORIES} | (counts or {}), threshold

    def assign(self, scores: dict[str, float], draw: int, flip: int) -> str:
        most = max(self.counts.values())
        lagging = {c for c, n in self.counts.items() if most - n >= self.threshold}
        if lagging:
            eligible = [t for t in L.TYPES if L.CATEGORY[t] in lagging]
            chosen = eligible[draw % len(eligible)]
        else:
            scale = max(self.threshold, most)
            chosen = max(L.TYPES, key=lambda t: (scores[t] * (scale + most - self.counts[L.CATEGORY[t]]), -L.TYPES.index(t)))
        if chosen in ("short", "multi_hop") and flip % 2 == 0:
            chosen += "_inverse"
        self.counts[L.CATEGORY[chosen]] += 1
        return chosen


def balanced(rows: DataFrame, scope: list[str], order: list[str], threshold: int = 10) -> DataFrame:
    """rows (score_<type> for all types, draw, flip) with assigned: a fold in `order` for each value of `scope`.

    The fold is sequential by its definition; everything before it is parallel, and scopes (books, shards) are folded
    side by side. Its state is five counts."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable").reset_index(drop=True)
        state = Balance(threshold=threshold)
        pdf["assigned"] = [state.assign({t: getattr(r, f"score_{t}") for t in L.TYPES}, int(r.draw), int(r.flip)) for r in pdf.itertuples(index=False)]
        return pdf

    schema = rows.schema.simpleString()[len("struct<") : -1] + ",assigned:string"
    return rows.groupBy(*scope).applyInPandas(fold, schema)


def balanced_ranges(rows: DataFrame, scope: str, order: str, threshold: int = 10, ranges: int | None = None) -> DataFrame:
    """scope, order, assigned: the same fold for scopes of any size, in constant memory.

    Rows are dealt into ranges of (scope, order) and written once. A range is folded row by row; it can be once the counts
    at its start are known, which is at once if its first scope begins in it. A scope over several ranges is passed from
    one to the next, five counts at a time, a wave of ranges a job: all scopes that are so long go on side by side. Null
    scopes are a scope. (scope, order) should be unique; rows that tie are folded in the order of their draws."""
    spark, folder = rows.sparkSession, shared_folder(rows.sparkSession, "balance")
    kinds = dict(rows.dtypes)
    keys = [F.col(scope).alias("scope"), F.col(order).alias("at")]
    scores = [f"score_{t}" for t in L.TYPES]
    columns = [F.col(c) for c in (*scores, "draw", "flip")]
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.select(*keys, *columns).repartitionByRange(n, "scope", "at").withColumn("part", F.spark_partition_id()).write.parquet(f"{folder}/in")
    dealt = spark.read.parquet(f"{folder}/in")
    edges = {r["part"]: r for r in dealt.groupBy("part").agg(F.min(F.struct("scope")).alias("first"), F.max(F.struct("scope")).alias("last")).collect()}
    parts = sorted(edges)
    follows = {b: a for a, b in zip(parts, parts[1:], strict=False) if edges[a]["last"] == edges[b]["first"]}
    known: dict[int, dict[str, int]] = {}
    schema = f"scope {kinds[scope]}, at {kinds[order]}, assigned string, part int, counts string"
    # A wave takes all ranges whose start is known; a scope that no range shares has but one.
    wave = [p for p in parts if p not in follows]
    number = 0
    while wave:
        starts = {p: known[follows[p]] for p in wave if p in follows}

        def fold(frames: Iterator[pd.DataFrame], starts=starts) -> Iterator[pd.DataFrame]:
            here, state = None, None
            for pdf in frames:
                out = []
                for r in pdf.itertuples(index=False):
                    now = (r.part, None if pd.isna(r.scope) else r.scope)
                    if now != here:
                        if here is not None and here[0] != r.part:
                            yield _tail(here, state)
                        first = here is None or here[0] != r.part
                        state = Balance(starts.get(r.part) if first else None, threshold)
                        here = now
                    out.append(state.assign({t: getattr(r, f"score_{t}") for t in L.TYPES}, int(r.draw), int(r.flip)))
                yield pdf[["scope", "at"]].assign(assigned=out, part=pdf["part"], counts=None)
            if here is not None:
                yield _tail(here, state)

        now = dealt.where(F.col("part").isin(wave)).repartition("part").sortWithinPartitions("part", "scope", "at", "draw", "flip")
        now.mapInPandas(fold, schema).write.parquet(f"{folder}/out/wave={number}")
        ended = spark.read.schema(schema).parquet(f"{folder}/out/wave={number}").where("counts IS NOT NULL")
        # Five counts a range.
        known |= {r["part"]: json.loads(r["counts"]) for r in ended.select("part", "counts").collect()}
        wave = [p for p in parts if p not in known and follows[p] in known]
        number += 1
    if not parts:
        return spark.createDataFrame([], f"{scope} {kinds[scope]}, {order} {kinds[order]}, assigned string")
    folded = spark.read.schema(f"{schema}, wave int").parquet(f"{folder}/out").where("counts IS NULL")
    return folded.select(F.col("scope").alias(scope), F.col("at").alias(order), "assigned")


def _tail(here: tuple, state: Balance) -> pd.DataFrame:
    """The counts at the end of a range, as a row of their own."""
    return pd.DataFrame({"scope": [None], "at": [None], "assigned": [None], "part": [here[0]], "counts": [json.dumps(state.counts)]})


def discounts(counts: dict[str, Column], threshold: int = 10) -> dict[str, Column]:
    """Discount factors of given category counts."""
    most = F.greatest(*counts.values())
    return {k: 1 + (most - n) / F.greatest(F.lit(threshold), most) for k, n in counts.items()}


def batches_of(rows: DataFrame, scope: str, order: str, size: int, start: int = 0, every: int = 20) -> DataFrame:
    """rows with batch and checkpoint: within each scope the rows after the first `start`, in lots of `size` (the last one
    may be short), and whether progress is saved at a row, every so many rows of all."""
    numbered = rows.withColumn("__rn", F.row_number().over(Window.partitionBy(scope).orderBy(order))).where(F.col("__rn") > start)
    return numbered.withColumns({"batch": F.floor((F.col("__rn") - 1) / size).cast("long"), "checkpoint": F.col("__rn") % every == 0}).drop("__rn")


def rendered(rows: DataFrame, templates: DataFrame) -> DataFrame:
    """rows (type, text) with the prompt of their type's template (name, template; a handful)."""
    named = templates.select(F.col("name").alias("type"), "template")
    return rows.join(F.broadcast(named), "type").withColumn("prompt", F.replace("template", F.lit(L.PLACEHOLDER), F.col("text"))).drop("template")


def truncated(c: Column | str, most: int) -> Column:
    """A prompt of more than `most` words cut to them; any other stays as it is."""
    w = X.words(c)
    return F.when(F.size(w) > most, F.array_join(F.slice(w, 1, most), " ")).otherwise(X.col(c))


#: The fields of a saved question that are cleaned of references, where it has them.
CLEANED = ("question", "answer", "incorrect_answer", "explanation")


def cleaned(rows: DataFrame) -> DataFrame:
    """rows with those of the four fields that they have cleaned; null stays null."""
    return rows.withColumns({c: F.when(F.col(c).isNotNull(), X.clean_references(c)) for c in CLEANED if c in rows.columns})


def source_of(isbn: str, page: str, paragraph_id: str) -> Column:
    """Where a question comes from, with defaults for what is unknown."""
    known = {"isbn": (isbn, "Unknown ISBN"), "page": (page, "Unknown Page"), "paragraph_id": (paragraph_id, "Unknown ID")}
    return F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit(default)).alias(name) for name, (c, default) in known.items()])


def sentence_variances(sentences: DataFrame, key: str) -> DataFrame:
    """key, coherence, entropy of sentences (key, v: the values of all their tokens). coherence: the sample variance over
    the tensor of all sentences padded with zeros to the longest, from sums alone, so no padding is made; entropy: the
    population variance over the sentences' means. One grouped aggregate; null where there are too few values."""
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    each = sentences.select(key, F.size("v").alias("n"), total(F.col("v")).alias("s"), total(F.transform("v", lambda x: x * x)).alias("q"))
    by = each.groupBy(key).agg((F.count("*") * F.max("n")).alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.var_pop(F.col("s") / F.col("n")).alias("entropy"))
    coherence = F.when(F.col("n") > 1, (F.col("q") - F.col("s") * F.col("s") / F.col("n")) / (F.col("n") - 1))
    return by.select(key, coherence.alias("coherence"), "entropy")
