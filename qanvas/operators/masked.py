"""The masked-model path: pools scanned from a vocabulary until they are full, suffix beams, windows round masks, pooling,
and the flow from a pool to final options.

Model output comes in as rows: the probabilities of all tokens at a mask are an array a question, from whatever model a
caller runs. A vocabulary is bounded (it is checked) and goes to every task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import text as X
from ..functions import vector as V
from ..functions.stem import stem
from . import choices as C
from . import flows as W

#: A vocabulary of more tokens is refused: it is broadcast.
MOST_TOKENS = 1_000_000


@dataclass
class Vocabulary:
    """What the candidate rules need to know about each token, as columns by token id."""

    word: np.ndarray
    suffix: np.ndarray
    known: np.ndarray
    profane: np.ndarray
    stem: np.ndarray
    vectors: np.ndarray | None = None
    upper: np.ndarray = field(init=False)
    first_upper: np.ndarray = field(init=False)
    short: np.ndarray = field(init=False)
    digit: np.ndarray = field(init=False)
    #: Tokens by their lowered word.
    by_lower: dict[str, list[int]] = field(init=False)

    def __post_init__(self) -> None:
        flag = lambda f: np.array([f(w) for w in self.word], dtype=bool)
        self.upper, self.short = flag(str.isupper), flag(lambda w: len(w) < 2)
        self.first_upper, self.digit = flag(lambda w: w[:1].isupper()), flag(lambda w: any(c.isdigit() for c in w))
        self.by_lower = {}
        for i, w in enumerate(self.word):
            self.by_lower.setdefault(w.lower(), []).append(i)

    def marked(self, words) -> np.ndarray:
        """Which tokens' lowered words are among these."""
        out = np.zeros(len(self.word), dtype=bool)
        for w in words:
            out[self.by_lower.get(w, [])] = True
        return out


def vocabulary_of(tokens: DataFrame) -> Vocabulary:
    """The vocabulary of tokens (token from 0 without gaps, word, suffix, known, profane, and vector, an array or null).
    `known` says that the word is in a lexicon; words that look like words are known as well. Raises if there are more
    than MOST_TOKENS."""
    if tokens.count() > MOST_TOKENS:
        raise ValueError(f"a vocabulary has {MOST_TOKENS} tokens at most")
    columns = [F.coalesce(c, F.lit(False)).alias(c) for c in ("suffix", "profane")]
    known = (F.coalesce("known", F.lit(False)) | F.coalesce(X.is_word("word"), F.lit(False))).alias("known")
    pdf = tokens.select("token", F.coalesce("word", F.lit("")).alias("word"), *columns, known, F.coalesce(stem("word"), F.lit("")).alias("stem"), "vector").toPandas().sort_values("token")
    if pdf["token"].tolist() != list(range(len(pdf))):
        raise ValueError("tokens must be numbered from 0 without gaps")
    vectors = np.array([np.asarray(v, dtype=float) for v in pdf["vector"]]) if len(pdf) and pdf["vector"].notna().all() else None
    return Vocabulary(*[pdf[c].to_numpy() for c in ("word", "suffix", "known", "profane", "stem")], vectors)


def context_order(p_sentence: np.ndarray, p_passage: np.ndarray, suffix: np.ndarray, alpha: float, e: float = V.EPS) -> np.ndarray:
    """ln(p_sentence + e) - alpha ln(p_passage + e) at 9 places; tokens that only continue words count as impossible."""
    inside = ~suffix
    return np.round(np.log(p_sentence * inside + e) - alpha * np.log(p_passage * inside + e), 9)


def falling_blocks(score: np.ndarray, first: int) -> Iterator[np.ndarray]:
    """All places in blocks of falling score, ties by place; each block is about twice as large as the one before. A block
    is parted off (ties with it), and only it is sorted: who stops early has not sorted the rest."""
    left, size = np.arange(len(score)), first
    while len(left):
        if size < len(left):
            least = np.partition(score[left], len(left) - size)[len(left) - size]
            inside = score[left] >= least
            block, left = left[inside], left[~inside]
        else:
            block, left = left, left[:0]
        yield block[np.lexsort((block, -score[block]))]
        size *= 2


#: Why a token is rejected, in the order of the rules. The first can't be overridden.
REASONS = ["case", "short", "first letter", "profane", "not a word", "neighbour", "digit", "not in text", "stem"]


def scanned(v: Vocabulary, score: np.ndarray, answer: str, answer_stem: str, passage: str, before: str, after: str, cosine: np.ndarray | None, size: int, unlike: float, in_text_only: bool) -> list[tuple[int, int, str | None]]:
    """(token, place, overridden reason) of the pool: tokens in order of score, each by the rules, until `size` are taken.

    A stem counts as used once a token was taken with it by all rules; a token that is taken because it is unlike the
    answer (cosine under `unlike`) in spite of an earlier rule uses up no stem."""
    in_text, near = v.marked(set(passage.lower().split())), v.marked({before, after})
    case = v.upper != answer.isupper()
    rules = [v.short, v.first_upper != answer[:1].isupper(), v.profane, ~v.known & ~in_text, near, v.digit, ~in_text & in_text_only]
    rejected = np.full(len(v.word), 0, dtype=np.int8)
    for i, rule in reversed(list(enumerate(rules, 1))):
        rejected[rule] = i
    differs = np.zeros(len(v.word), dtype=bool) if cosine is None else cosine < unlike
    out, used, place = [], {answer_stem}, 0
    for block in falling_blocks(score, 4 * size):
        for at in np.flatnonzero(~case[block]):
            token = int(block[at])
            why = int(rejected[token])
            if not why and v.stem[token] in used:
                why = len(REASONS) - 1
            if why and not differs[token]:
                continue
            if not why:
                used.add(v.stem[token])
            out.append((token, place + int(at) + 1, REASONS[why] if why else None))
            if len(out) >= size:
                return out
        place += len(block)
    return out


def neighbours(passage: str, mask: str) -> tuple[str, str]:
    """The lowered words beside the first word with a mask; marks of the ends where there is none."""
    words = passage.lower().split()
    at = next((i for i, w in enumerate(words) if mask.lower() in w), None)
    if at is None:
        return L.BEFORE_TEXT, L.AFTER_TEXT
    return words[at - 1] if at else L.BEFORE_TEXT, words[at + 1] if at + 1 < len(words) else L.AFTER_TEXT


def mask_pools(asked: DataFrame, vocabulary: Vocabulary, size: int = 64, alpha: float = 0.4, unlike: float = 0.8, in_text_only: bool = False, mask: str = "<mask>") -> DataFrame:
    """qid, slot, token, word, place, reason, p_sentence, p_passage: the pools of asked (qid, answer, passage with the mask,
    p_sentence and p_passage (arrays by token), and vector, the answer's embedding or null).

    `place` is the token's place in the order of scores, so the last one's tells how far the scan went. There is no
    shuffle: a question's probabilities are a row. Null answers and passages are empty; questions without probabilities
    (null, or not one a token) have no pool."""
    shared = asked.sparkSession.sparkContext.broadcast(vocabulary)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = shared.value
        lengths = None if v.vectors is None else np.linalg.norm(v.vectors, axis=1)
        for pdf in frames:
            rows = []
            for r in pdf.itertuples(index=False):
                ps, pp = (np.asarray([] if p is None else p, dtype=float) for p in (r.p_sentence, r.p_passage))
                if len(ps) != len(v.word) or len(pp) != len(v.word) or not len(ps):
                    continue
                answer, passage, cosine = r.answer or "", r.passage or "", None
                if v.vectors is not None and r.vector is not None:
                    own = np.asarray(r.vector, dtype=float)
                    product = lengths * np.linalg.norm(own)
                    cosine = np.where(product == 0, 1.0, v.vectors @ own / np.where(product == 0, 1, product))
                found = scanned(v, context_order(ps, pp, v.suffix, alpha), answer, r.answer_stem or "", passage, *neighbours(passage, mask), cosine, size, unlike, in_text_only)
                rows += [(r.qid, i, t, v.word[t], place, why, ps[t], pp[t]) for i, (t, place, why) in enumerate(found, 1)]
            yield pd.DataFrame(rows, columns=["qid", "slot", "token", "word", "place", "reason", "p_sentence", "p_passage"])

    rows = asked.select("qid", "answer", "passage", "p_sentence", "p_passage", "vector", stem("answer").alias("answer_stem"))
    return rows.mapInPandas(run, "qid long, slot int, token int, word string, place int, reason string, p_sentence double, p_passage double")


def likeliest(p: np.ndarray, allowed: np.ndarray, width: int) -> list[dict]:
    """The `width` tokens of largest probability among the allowed ones (token numbers), ties by token, with it."""
    own = allowed[allowed < len(p)]
    if len(own) > width:
        least = np.partition(p[own], len(own) - width)[len(own) - width]
        own = own[p[own] >= least]
    own = own[np.lexsort((own, -p[own]))][:width]
    return [{"token": int(t), "p": float(p[t])} for t in own]


def with_likeliest(states: DataFrame, allowed: dict[str, list[bool]], width: int) -> DataFrame:
    """states (p, the probabilities of all tokens) without p, and with a column of the likeliest tokens for each set."""
    kept = [c for c in states.columns if c != "p"]
    may = {name: np.flatnonzero(np.asarray(x, dtype=bool)) for name, x in allowed.items()}
    kind = pa.list_(pa.struct([("token", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of probabilities are views of the batch, so it is held once, and a lot at a time goes back.
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                lot = batch.slice(at, 1000)
                p = lot.column("p")
                rows = [p[i].values.to_numpy(zero_copy_only=False) if p[i].is_valid else np.zeros(0) for i in range(len(p))]
                best = [pa.array([likeliest(x, tokens, width) for x in rows], kind) for tokens in may.values()]
                yield pa.RecordBatch.from_arrays([*[lot.column(c) for c in kept], *best], [*kept, *may])

    kinds = dict(states.dtypes)
    schema = ", ".join([*[f"{c} {kinds[c]}" for c in kept], *[f"{name} array<struct<token:int,p:double>>" for name in allowed]])
    return states.mapInArrow(run, schema)


def beam_suffixes(asked: DataFrame, pieces: list[tuple[str, bool]], words: DataFrame, score: Callable[[DataFrame], DataFrame], width: int = 5) -> DataFrame:
    """qid, start, tokens, p: for each of asked (qid, start, depth) the likeliest word that ends in the piece `start`.

    A beam: the state is what stands behind the mask. In each step a state's `width` likeliest beginnings are tried (the
    first that makes a word counts, with its probability), and its `width` likeliest suffixes each make a longer state,
    until `depth` pieces are in front of `start`. Of all that was found the largest probability wins; ties go to what a
    search would meet first, shorter words before longer ones and likelier suffixes before others. Nothing found: no
    tokens and 0. `score` adds p, the probabilities of all tokens in front of the state, to rows (qid, start, tokens,
    step); pieces are (text, whether it is a suffix) by token; words (word): what counts as a word, lowered. Each step is
    a map and a join with the words; states are `width` to the power of the step a row at most."""
    texts = F.array(*[F.lit(t) for t, _ in pieces])
    starts, ends = [not s for _, s in pieces], [s for _, s in pieces]
    known = words.select(F.lower("word").alias("word")).distinct()
    state = asked.select("qid", "start", "depth", F.array("start").alias("tokens"), F.array().cast("array<int>").alias("path"), F.get(texts, F.col("start")).alias("text"))
    found, depth = [], asked.agg(F.max("depth")).first()[0] or 0
    for step in range(1, depth + 1):
        state = state.where(F.col("depth") >= step)
        rated = score(state.withColumn("step", F.lit(step))).select("qid", "start", "depth", "tokens", "path", "text", "p")
        rated = with_likeliest(rated, {"first": starts} | ({"next": ends} if step < depth else {}), width)
        tried = rated.select("qid", "start", "tokens", "path", "text", F.posexplode("first").alias("rank", "t"))
        tried = tried.withColumn("word", F.lower(F.concat(F.get(texts, F.col("t.token")), "text")))
        first = tried.join(known, "word").groupBy("qid", "start", "path").agg(F.min(F.struct("rank", "t", "tokens")).alias("b"))
        found.append(first.select("qid", "start", (-F.col("b.t.p")).alias("less"), "path", F.concat(F.array("b.t.token"), "b.tokens").alias("tokens")))
        if step < depth:
            longer = rated.select("qid", "start", "depth", "tokens", "path", "text", F.posexplode("next").alias("rank", "t"))
            state = longer.select("qid", "start", "depth", F.concat(F.array("t.token"), "tokens").alias("tokens"), F.concat("path", F.array("rank")).alias("path"), F.concat(F.get(texts, F.col("t.token")), "text").alias("text"))
    asked = asked.select("qid", "start")
    if not found:
        return asked.select("qid", "start", F.array().cast("array<int>").alias("tokens"), F.lit(0.0).alias("p"))
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    # A probability of 0 is never better than nothing.
    best = every.where("less < 0").groupBy("qid", "start").agg(F.min(F.struct("less", "path", "tokens")).alias("b"))
    return asked.join(best, ["qid", "start"], "left").select("qid", "start", F.coalesce("b.tokens", F.array().cast("array<int>")).alias("tokens"), F.coalesce(-F.col("b.less"), F.lit(0.0)).alias("p"))


def mask_windows(texts: DataFrame, mask: Column, limit: int = 4096, step: int = 100) -> DataFrame:
    """key, mask_at, dropped, mask_in, window: for each masked token (from 0) of texts (key, tokens) the tokens that a model
    of `limit` tokens gets: tokens go from the front, `step` at a time, until the mask is inside, and from the back."""
    masks = texts.select("key", "tokens", F.explode(F.filter(F.sequence(F.lit(0), F.size("tokens") - 1), lambda i: mask(F.get("tokens", i)))).alias("mask_at")).where(F.size("tokens") > 0)
    dropped = F.when(F.col("mask_at") >= limit, F.ceil((F.col("mask_at") - (limit - 1)) / step) * step).otherwise(0).cast("int")
    rows = masks.withColumn("dropped", dropped)
    return rows.select("key", "mask_at", "dropped", (F.col("mask_at") - F.col("dropped")).alias("mask_in"), F.slice("tokens", F.col("dropped") + 1, limit).alias("window"))


def masked_mean(vectors: Column | str, mask: Column | str) -> Column:
    """The mean of the vectors whose mask is not 0, of ragged length; null where none is. Null masks are 0."""
    inside = F.filter(F.zip_with(X.col(vectors), X.col(mask), lambda v, m: F.when(F.coalesce(m, F.lit(0)) != 0, V.doubles(v))), lambda v: v.isNotNull())
    added = F.aggregate(inside, F.array().cast("array<double>"), lambda a, v: F.when(F.size(a) == 0, v).otherwise(F.zip_with(a, v, lambda x, y: x + y)))
    return F.when(F.size(inside) > 0, F.transform(added, lambda x: x / F.size(inside)))


def sentence_windows(texts: DataFrame, least_words: int) -> DataFrame:
    """key, at, lo, hi, n_words: round every sentence (from 0) of texts (key, sentences) the sentences that it is widened to,
    by the next and the previous one in turn, or the only ones left, until there are `least_words` words.

    After s steps the window is fixed by s alone, and its words are a difference of two running sums, so the least s is
    found by halving. Running sums are a window within a text; a text's sums then stand in each of its rows once."""
    each = texts.select("key", F.posexplode("sentences").alias("at", "sentence")).select("key", "at", X.word_count("sentence").alias("n"))
    summed = each.withColumn("sum", F.sum("n").over(Window.partitionBy("key").orderBy("at")))
    sums = summed.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "sum"))), lambda x: x["sum"].cast("int")).alias("sums"))
    rows = sums.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("sums") - 1)))
    n = F.size("sums")

    def edges(s: Column) -> tuple[Column, Column]:
        """First and last sentence after s steps: half of them (the odd one too) to the right, unless a side has ended."""
        right = F.least(n - 1 - F.col("at"), F.greatest(F.ceil(s / 2), s - F.col("at"))).cast("int")
        return F.col("at") - (s - right), F.col("at") + right

    def words(s: Column) -> Column:
        lo, hi = edges(s)
        return F.get("sums", hi) - F.coalesce(F.when(lo > 0, F.get("sums", lo - 1)), F.lit(0))

    state = F.struct(F.lit(0).alias("low"), (n - 1).alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        enough = words(middle) >= least_words
        return F.when(s["low"] >= s["high"], s).otherwise(F.struct(F.when(enough, s["low"]).otherwise(middle + 1).alias("low"), F.when(enough, middle).otherwise(s["high"]).alias("high")))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(n + F.lit(1))).cast("int"))
    found = rows.withColumn("s", F.aggregate(steps, state, halve)["low"])
    lo, hi = edges(F.col("s"))
    return found.select("key", "at", lo.alias("lo"), hi.alias("hi"), words(F.col("s")).alias("n_words"))


def masked_flow(asked: DataFrame, vocabulary: Vocabulary, lexicon: DataFrame, vectors: Callable[[DataFrame], DataFrame], n: int = 3, size: int = 64, alpha: float = 0.4, beta: float = 0.3, gamma: float = 0.4, unlike: float = 0.8, exact: bool = False, mask: str = "<mask>") -> DataFrame:
    """qid, answer, pool, distractors, options of asked (qid, answer, passage, p_sentence, p_passage, vector, existing,
    completion, fallback): from the masked model to final options.

    1. The pool of mask_pools. 2. A pool of fewer than n gets 2n words of the lexicon, with probabilities 0.5 and 1.5.
    3. Existing options that are neither the answer nor in the pool come behind, with probabilities of 1. 4. Of a pool of
    more than n the energy chooses n (annealed, or exactly); of any other pool all are taken. 5. A question without a pool
    takes the bulleted parts of its completion; one with fewer than n the comma parts of its fallback, if there are any.
    6. Answer and distractors are shuffled. `vectors` adds vector to rows (qid, word). A question's pool is `size` words,
    2n words and its options at most, which bounds every group here."""
    asked = asked.withColumn("answer", F.coalesce("answer", F.lit("")))
    pools = mask_pools(asked, vocabulary, size, alpha, unlike, mask=mask).select("qid", F.lit(0).alias("kind"), F.col("slot").alias("position"), "word", "p_sentence", "p_passage")
    counted = asked.select("qid", "answer").join(pools.groupBy("qid").agg(F.count("*").alias("c")), "qid", "left").where(F.coalesce("c", F.lit(0)) < n)
    extra = C.fallback_words(lexicon, counted.select("qid", "answer"), n)
    extra = extra.select("qid", F.lit(1).alias("kind"), F.row_number().over(Window.partitionBy("qid").orderBy("word")).alias("position"), "word", F.lit(0.5).alias("p_sentence"), F.lit(1.5).alias("p_passage"))
    old = asked.select("qid", F.posexplode(C.wrong_options("existing", "answer")).alias("position", "word")).select("qid", F.lit(2).alias("kind"), "position", "word", F.lit(1.0).alias("p_sentence"), F.lit(1.0).alias("p_passage"))
    # Fallback words that the pool has, and options that the pool or the fallback has, are no second candidates.
    both = pools.unionByName(extra).unionByName(old)
    once = both.withColumn("again", F.row_number().over(Window.partitionBy("qid", "word").orderBy("kind", "position"))).where("again = 1").drop("again")
    placed = once.withColumn("i", F.row_number().over(Window.partitionBy("qid").orderBy("kind", "position")).cast("long"))
    w = Window.partitionBy("qid")
    rated = vectors(placed).join(asked.select("qid", F.col("vector").alias("answer_vector")), "qid")
    rated = rated.withColumns({"raw": V.context_score(F.col("p_sentence"), F.col("p_passage"), alpha), "cos": V.cosine("vector", "answer_vector")})
    scaled = lambda c: V.min_max(F.col(c), F.min(c).over(w), F.max(c).over(w))
    rated = rated.select("qid", "i", "word", scaled("raw").alias("ctx"), scaled("cos").alias("sim"), F.col("vector").alias("embedding"), F.col("answer_vector").alias("answer"))
    chosen = C.select_candidates(rated.drop("word"), n, beta, gamma, exact=exact).select("qid", "slot", "i")
    picked = chosen.join(placed.select("qid", "i", "word"), ["qid", "i"]).groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("slot", "word"))).alias("d"))
    listed = placed.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("w"))
    texts = lambda c: F.coalesce(F.transform(c, lambda x: x["word"]), F.array().cast("array<string>"))
    rows = asked.select("qid", "answer", "completion", "fallback").join(listed, "qid", "left").join(picked, "qid", "left")
    rows = rows.select("qid", "answer", "completion", texts("w").alias("pool"), texts("d").alias("d"), C.comma_candidates(F.coalesce("fallback", F.lit("")), "answer", n).alias("parts"))
    few = F.when(F.size("parts") > 0, F.col("parts")).otherwise(F.col("d"))
    found = F.when(F.size("pool") == 0, C.completion_candidates(F.coalesce("completion", F.lit("")), "answer", n)).when(F.size("d") < n, few).otherwise(F.col("d"))
    return W.finished(rows.select("qid", "answer", "pool", found.alias("distractors")), n)
