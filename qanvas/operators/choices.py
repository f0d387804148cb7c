"""Multiple-choice repair, passage lookup, candidate filters, scoring and selection of distractors."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import text as X
from ..functions import vector as V


def suffix_map(texts: DataFrame) -> DataFrame:
    """text, longer: for each distinct text the largest other one that ends in it and is one or two characters longer.
    Candidates are cut by one and two characters and joined on equality, not compared pair by pair."""
    t = texts.select("text").where("text <> ''").distinct()
    cut = t.select(F.col("text").alias("longer"), F.explode(F.array(F.substr("text", F.lit(2)), F.substr("text", F.lit(3)))).alias("text"))
    return t.join(cut.where((F.col("text") != "") & (F.length("longer") > F.length("text"))), "text").groupBy("text").agg(F.max("longer").alias("longer"))


def repaired(items: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """items (qid, options, answer) with broken options replaced by their longer form (one hop), capitalised, and
    without repeats by lowered, stripped text (the first stays); the answer is mapped the same way. Longer forms are
    looked for among all options and answers, and texts (text), if given."""
    options = items.select("qid", F.posexplode("options").alias("position", "text"))
    known = options.select("text").unionByName(items.select(F.col("answer").alias("text")))
    fix = suffix_map(known if texts is None else known.unionByName(texts.select("text")))
    mapped = lambda df: df.join(fix, "text", "left").withColumn("text", X.capitalised(F.coalesce("longer", "text"))).drop("longer")
    kept = mapped(options).groupBy("qid", F.lower(X.strip("text")).alias("k")).agg(F.min(F.struct("position", "text")).alias("o"))
    lists = kept.groupBy("qid").agg(F.array_sort(F.collect_list("o")).alias("o")).select("qid", F.transform("o", lambda o: o["text"]).alias("options"))
    answers = mapped(items.select("qid", F.col("answer").alias("text"))).select("qid", F.col("text").alias("answer"))
    return answers.join(lists, "qid", "left").select("qid", F.coalesce("options", F.array().cast("array<string>")).alias("options"), "answer")


#: Texts of more characters are held together by segments, shorter ones by what is left when characters go.
SHORT_TEXT = 24


def _without(c: Column) -> Column:
    """All that is left of a text when one character goes, each once."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.overlay(c, F.lit(""), i, F.lit(1))))


def _neighbourhood(c: Column, edits: int) -> Column:
    """The text, and all that is left of it when up to `edits` characters go."""
    rings = [F.array(c)]
    for _ in range(edits):
        rings.append(F.array_distinct(F.flatten(F.transform(F.filter(rings[-1], lambda x: x != ""), _without))))
    return F.array_distinct(F.concat(*rings))


def _segments(n: Column, edits: int) -> Column:
    """(number, start from 1, length) of the edits + 1 parts into which a text of n characters is cut."""
    size = F.floor(n / (edits + 1)).cast("int")
    return F.transform(F.sequence(F.lit(0), F.lit(edits)), lambda i: F.struct(i.alias("part"), (i * size + 1).alias("start"), F.when(i == edits, n - edits * size).otherwise(size).alias("size")))


def _by_parts(tried: DataFrame, whole: DataFrame, most_edits: int) -> DataFrame:
    """text, match: of long texts (text), those tried and those whole of which a part stands in them near its place."""
    n = F.length("text")
    own = whole.select(F.col("text").alias("match"), F.length("text").alias("n"), F.explode(_segments(n, most_edits)).alias("s"))
    own = own.select("match", "n", "s.part", F.substring("match", F.col("s.start"), F.col("s.size")).alias("key"))
    sizes = tried.select("text", F.explode(F.sequence(n - most_edits, n + most_edits)).alias("n"))
    places = sizes.select("text", "n", F.explode(_segments(F.col("n"), most_edits)).alias("s")).select("text", "n", "s.part", "s.size", F.explode(F.sequence(F.greatest(F.lit(1), F.col("s.start") - most_edits), F.col("s.start") + most_edits)).alias("start"))
    keyed = places.select("text", "n", "part", F.substring("text", F.col("start"), F.col("size")).alias("key")).distinct()
    return keyed.join(own, ["n", "part", "key"]).where("text <> match").select("text", "match")


def close_pairs(texts: DataFrame, most_edits: int = 2) -> DataFrame:
    """text, match, edits: all pairs of different texts (text, distinct and not empty) within most_edits edits, both ways.

    No pair is missed, and none is compared that shares nothing. Short texts: two within k edits leave a common rest when
    each loses up to k characters, so rests are joined by equality. Longer texts would leave too many rests: of k + 1
    parts of a text, one stands unchanged within k places in any text within k edits, so parts are joined by equality.
    What is joined is verified."""
    n = F.length("text")
    rests = texts.where(n <= SHORT_TEXT + most_edits).select("text", F.explode(_neighbourhood(F.col("text"), most_edits)).alias("key"))
    short = rests.join(rests.select(F.col("text").alias("match"), "key"), "key").where("text < match").select("text", "match")
    long = texts.where(n > SHORT_TEXT)
    far = _by_parts(long, long, most_edits).select(F.least("text", "match").alias("text"), F.greatest("text", "match").alias("match"))
    # A pair is made and verified once, and given both ways.
    near = short.unionByName(far).distinct().withColumn("edits", F.levenshtein("text", "match")).where(F.col("edits") <= most_edits)
    ways = F.array(F.struct("text", "match", "edits"), F.struct(F.col("match").alias("text"), F.col("text").alias("match"), "edits"))
    return near.select(F.explode(ways).alias("w")).select("w.*")


def close_match(texts: DataFrame, most_edits: int = 2) -> DataFrame:
    """text, match: the nearest other text within most_edits edits, ties to the smallest. Texts that have one within fewer
    edits are done with it: only the others are held against all texts by more edits, which leave many more rests."""
    t = texts.select("text").where("text <> ''").distinct()
    nearest = lambda pairs: pairs.groupBy("text").agg(F.min(F.struct("edits", "match")).alias("m")).select("text", F.col("m.match").alias("match"))
    if most_edits < 2:
        return nearest(close_pairs(t, most_edits))
    done = close_match(t, most_edits - 1)
    left = t.join(done.select("text"), "text", "left_anti")
    return done.unionByName(nearest(_close_to(left, t, most_edits)))


def _close_to(asked: DataFrame, texts: DataFrame, most_edits: int) -> DataFrame:
    """text, match, edits: the pairs of close_pairs whose text is among asked, one way."""
    n = F.length("text")
    rests = lambda df: df.where(n <= SHORT_TEXT + most_edits).select("text", F.explode(_neighbourhood(F.col("text"), most_edits)).alias("key"))
    short = rests(asked).join(rests(texts).withColumnRenamed("text", "match"), "key").where("text <> match").select("text", "match")
    far = _by_parts(asked.where(n > SHORT_TEXT), texts.where(n > SHORT_TEXT), most_edits)
    return short.unionByName(far).distinct().withColumn("edits", F.levenshtein("text", "match")).where(F.col("edits") <= most_edits)


def with_passage(questions: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """questions with passage, from the first paragraph of their (isbn, paragraph_id); empty where there is none."""
    first = paragraphs.groupBy("isbn", "paragraph_id").agg(F.min(F.struct("position", "text")).alias("p"))
    first = first.select("isbn", "paragraph_id", X.flat_passage("p.text").alias("passage"))
    return questions.join(first, ["isbn", "paragraph_id"], "left").na.fill({"passage": ""})


def wrong_options(options: Column | str, answer: Column | str) -> Column:
    return F.filter(X.col(options), lambda o: (o != "") & (o != X.col(answer)))


def listed_candidates(completions: DataFrame, pool: int = 64) -> DataFrame:
    """qid, rank, candidate from numbered lines of completions (qid, answer, completion): filtered, each once by lowered
    text, the first `pool` in order."""
    lines = completions.select("qid", "answer", F.posexplode(F.regexp_extract_all("completion", F.lit(r"(?m)^[ \t]*\d+[.)]?[ \t]*(.+)"), 1)).alias("position", "raw"))
    c, low = X.strip("raw"), F.lower(X.strip("raw"))
    fine = (c != "") & (low != F.lower(X.strip("answer"))) & ~low.rlike(r"^(answer:|correct)") & ~low.rlike(r"^(distractor|option) [0-9]") & ~c.endswith("?")
    once = lines.where(fine).groupBy("qid", low.alias("k")).agg(F.min(F.struct("position", c.alias("candidate"))).alias("c"))
    ranked = once.select("qid", F.row_number().over(Window.partitionBy("qid").orderBy("c.position")).alias("rank"), F.col("c.candidate").alias("candidate"))
    return ranked.where(F.col("rank") <= pool)


def split_candidates(completion: Column | str, answer: Column | str, n: int = 3) -> Column:
    """Parts between list delimiters that are not the answer, distinct, the first n."""
    parts = F.transform(F.split(X.col(completion), r"[\n,;•\-]+"), X.strip)
    return F.slice(F.array_distinct(F.filter(parts, lambda p: (p != "") & (F.lower(p) != F.lower(X.col(answer))))), 1, n)


def comma_candidates(completion: Column | str, answer: Column | str, n: int = 3) -> Column:
    parts = F.transform(F.split(X.col(completion), ","), X.strip)
    return F.slice(F.filter(parts, lambda p: (p != "") & (p != X.col(answer))), 1, n)


def completion_candidates(completion: Column | str, answer: Column | str, n: int = 3) -> Column:
    """Bulleted lines behind the last "Distractors:" without the answer; default options where there is none."""
    tail = F.element_at(F.split(X.col(completion), "Distractors:"), -1)
    items = F.transform(F.split(tail, "\n"), lambda x: F.regexp_replace(x, r"^[-•\n ]+|[-•\n ]+$", ""))
    kept = F.slice(F.filter(items, lambda x: (x != "") & ~F.contains(F.lower(x), F.lower(X.col(answer)))), 1, n)
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(*map(F.lit, L.DEFAULT_OPTIONS)))


def mask_candidate_reason(word: Column, answer: Column, passage_words: Column, before: Column, after: Column, in_lexicon: Column, profane: Column, stem: Column, answer_stem: Column, in_text_only: bool = False) -> Column:
    """Why a masked-model candidate is rejected, by the first rule that does; null if none. Stems that are used up by
    earlier candidates are the rule behind these: with_used_stems."""
    upper = lambda c: c.rlike(r"\p{Lu}") & ~c.rlike(r"\p{Ll}")
    first_upper = lambda c: F.substring(c, 1, 1).rlike(r"\p{Lu}")
    in_passage = F.array_contains(passage_words, F.lower(word))
    out = (
        F.when(upper(word) != upper(answer), "case").when(F.length(word) < 2, "short").when(first_upper(word) != first_upper(answer), "first letter")
        .when(profane, "profane").when(~(X.is_word(word) | in_lexicon | in_passage), "not a word")
        .when((F.lower(word) == F.lower(before)) | (F.lower(word) == F.lower(after)), "neighbour").when(word.rlike("[0-9]"), "digit")
    )
    if in_text_only:
        out = out.when(~in_passage, "not in text")
    return out.when(stem == answer_stem, "stem")


def with_used_stems(candidates: DataFrame, order: str) -> DataFrame:
    """candidates (qid, stem, reason) with the reason `stem` where an earlier candidate of the question, one that no rule
    rejects, has the same stem. Rejected candidates use up no stem."""
    w = Window.partitionBy("qid", "stem").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    used = F.count_if(F.col("reason").isNull()).over(w) > 0
    return candidates.withColumn("reason", F.coalesce("reason", F.when(used, "stem")))


def mask_candidate_kept(reason: Column, similarity_to_answer: Column, least: float = 0.8) -> Column:
    """Any rejection but the first rule's is overridden where the candidate is unlike the answer."""
    return reason.isNull() | ((reason != "case") & (similarity_to_answer < least))


def pool(candidates: DataFrame, n: int, alpha: float = 0.4) -> DataFrame:
    """candidates (qid, word, p_sentence, p_passage) with their context score and rank, the n best a question."""
    score = V.context_score(F.col("p_sentence"), F.col("p_passage"), alpha)
    ranked = candidates.withColumn("score", score).withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "word")))
    return ranked.where(F.col("rank") <= n)


def with_existing(pool: DataFrame, existing: DataFrame) -> DataFrame:
    """The words (qid, position, word) of a pool and of the options that are there already, each once by its lowered text;
    the pool's come first. existing: 1 for what only the options have."""
    both = pool.withColumn("existing", F.lit(0)).unionByName(existing.withColumn("existing", F.lit(1)))
    first = both.groupBy("qid", F.lower(X.strip("word")).alias("k")).agg(F.min(F.struct("existing", "position", "word")).alias("w"))
    return first.select("qid", "w.word", "w.existing", "w.position")


def top_tokens(rows: DataFrame, k: int) -> DataFrame:
    """qid, token, rank: the k best scores of rows (qid, logits), ties by token."""
    scored = F.transform("logits", lambda x, i: F.struct((-x).alias("minus"), i.alias("token")))
    best = F.slice(F.array_sort(scored), 1, k)
    return rows.select("qid", F.posexplode(best).alias("place", "t")).select("qid", "t.token", (F.col("place") + 1).alias("rank"))


def fallback_words(lexicon: DataFrame, answers: DataFrame, n: int, seed: str = "fallback", bits: int = 12) -> DataFrame:
    """qid, word: 2n lexicon words a question in a random order fixed by the seed, for pools that are too small. The
    order is one for all words; each question starts at a place of its own in it and goes on from the end at the front.
    Places come from counts by the first bits of the hash, so no task sorts all words and no pair of all words is formed."""
    hashes = lexicon.select("word", X.hashed(seed, "word").alias("h")).withColumn("bin", F.shiftright("h", 32 - bits))
    # One row a bin, 2^bits at most.
    before = hashes.groupBy("bin").agg(F.count("*").alias("n")).select("bin", F.coalesce(F.sum("n").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = F.col("before") + F.row_number().over(Window.partitionBy("bin").orderBy("h", "word")) - 1
    placed = hashes.join(F.broadcast(before), "bin").select("word", place.alias("place"))
    size = hashes.agg(F.count("*").alias("size")).where("size > 0")
    steps = F.explode(F.sequence(F.lit(0), F.least(F.lit(2 * n), F.col("size")).cast("int") - 1))
    asked = answers.crossJoin(F.broadcast(size)).select("qid", "answer", "size", (X.hashed(seed, "qid") % F.col("size")).alias("start"), steps.alias("step"))
    picked = asked.withColumn("place", (F.col("start") + F.col("step")) % F.col("size")).join(placed, "place")
    return picked.where(F.lower("word") != F.lower("answer")).select("qid", X.capitalised("word").alias("word"))


def pair_distances(candidates: DataFrame) -> DataFrame:
    """qid, i, j, distance for i < j: cosine distances of a question's candidates (qid, i, embedding); a question has
    a bounded pool."""
    normed = candidates.select("qid", "i", "embedding", V.norm("embedding").alias("norm"))
    a = normed.select("qid", "i", F.col("embedding").alias("x"), F.col("norm").alias("norm_x"))
    b = normed.select("qid", F.col("i").alias("j"), F.col("embedding").alias("y"), F.col("norm").alias("norm_y"))
    cosine = V.cosine_by_norms("x", "y", F.col("norm_x"), F.col("norm_y"))
    return a.join(b, "qid").where("i < j").select("qid", "i", "j", (1 - cosine).alias("distance"))


#: A task of all_pair_distances has so many vectors in a block, and makes so many pairs at a time.
BLOCK, PAIRS = 1024, 1 << 17


def all_pair_distances(candidates: DataFrame, block: int = BLOCK) -> DataFrame:
    """qid, i, j, distance for i < j as pair_distances, for pools of any size: a pool of one block is a group; larger ones
    are packed into rows of a block each, which are dealt to pieces, and each two pieces are a task of a cartesian product.
    So a vector is shuffled twice, whatever the size of its pool (tasks read the same shuffle files again and again), memory
    goes with the block, and one large pool is all tasks' work. A pool of n vectors lists n * (n - 1) / 2 pairs, as asked."""
    rows = candidates.select("qid", "i", "embedding").where("qid IS NOT NULL AND i IS NOT NULL")
    qid, i, embedding = (f.dataType.simpleString() for f in rows.schema)
    out = f"qid {qid}, i {i}, j {i}, distance double"

    def one_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _blocks(batches, block)
        first = next(blocks)
        if next(blocks, None) is None:
            yield from _distances(first["qid"][0], first["i"], first["embedding"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _blocks(batches, block)
        first, second = next(blocks), next(blocks, None)
        for number, rows in enumerate(chain([first, second], blocks) if second is not None else ()):
            whole = pa.array([0, rows.num_rows], pa.int32())
            yield pa.RecordBatch.from_arrays([rows["qid"].slice(0, 1), pa.array([number], pa.int64()), *(pa.ListArray.from_arrays(whole, rows[c]) for c in ("i", "embedding"))], names=["qid", "block", "ids", "vectors"])

    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)
    # Rows in a fixed order, so that a task that is run again packs the same blocks.
    pools = rows.repartition("qid").sortWithinPartitions("qid", "i", "embedding").groupBy("qid")
    small = pools.applyInArrow(one_block, out)
    blocks = pools.applyInArrow(packed, f"qid {qid}, block long, ids array<{i}>, vectors array<{embedding}>").repartition(math.ceil(math.sqrt(tasks)))
    others = blocks.select(F.col("qid").alias("other_qid"), F.col("block").alias("other"), F.col("ids").alias("other_ids"), F.col("vectors").alias("other_vectors"))
    met = blocks.hint("shuffle_replicate_nl").join(others, (F.col("qid") == F.col("other_qid")) & (F.col("block") <= F.col("other")))
    return small.unionByName(met.select("qid", "ids", "vectors", "other_ids", "other_vectors", (F.col("block") == F.col("other")).alias("same")).mapInArrow(_block_distances, out))


def _blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """A pool's rows in blocks, the last of which may be shorter; only a block and a batch are held."""
    held = pa.Table.from_batches([next(batches)])
    for batch in batches:
        while held.num_rows >= block:
            yield held.slice(0, block).combine_chunks().to_batches()[0]
            held = held.slice(block)
        held = pa.concat_tables([held, pa.Table.from_batches([batch])])
    for at in range(0, held.num_rows, block):
        yield held.slice(at, block).combine_chunks().to_batches()[0]


def _block_distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs between two blocks of a pool, or within one, a row of blocks at a time."""
    for batch in batches:
        for at in range(batch.num_rows):
            ids, vectors, other_ids, other_vectors = (batch[c][at].values for c in ("ids", "vectors", "other_ids", "other_vectors"))
            if batch["same"][at].as_py():
                yield from _distances(batch["qid"][at], ids, vectors)
            else:
                yield from _distances(batch["qid"][at], pa.concat_arrays([ids, other_ids]), pa.concat_arrays([vectors, other_vectors]), len(ids))


def _distances(qid: pa.Scalar, ids: pa.Array, vectors: pa.ListArray, split: int = 0) -> Iterator[pa.RecordBatch]:
    """The pairs of vectors, in order of their ids; with a split only those of a vector before it and one behind."""
    x, length, known = _matrix(vectors)
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    rank = pc.rank(ids, sort_keys="ascending", tiebreaker="dense").to_numpy().astype(np.int64)
    order = np.argsort(rank, kind="stable")
    plain = known.all() and (length == length[:1]).all()
    left, right = order[order < split], order[order >= split]
    for firsts, seconds in [(left, right), (right, left)] if split else [(order, order)]:
        begin = np.searchsorted(rank[seconds], rank[firsts], side="right")
        step = max(1, PAIRS // max(1, len(seconds)))
        for at in range(0, len(firsts), step):
            p, q = firsts[at : at + step], seconds[begin[at] :]
            if not len(q):
                break
            before = rank[p][:, None] < rank[q]
            n = norm[p][:, None] * norm[q]
            with np.errstate(divide="ignore", invalid="ignore"):
                distance = 1 - np.where(n == 0, 1.0, x[p] @ x[q].T / n)
            missing = None if plain else (~(known[p][:, None] & known[q]) | (length[p][:, None] != length[q]) & (n != 0))[before]
            i, j = np.repeat(p, before.sum(axis=1)), np.broadcast_to(q, before.shape)[before]
            yield pa.RecordBatch.from_arrays([pa.repeat(qid, len(i)), ids.take(pa.array(i)), ids.take(pa.array(j)), pa.array(distance[before], mask=missing)], names=["qid", "i", "j", "distance"])


def _matrix(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors as rows of doubles (short ones with zeros behind), their lengths, and whether they and all they hold are known."""
    length = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    values, known = lists.flatten(), lists.is_valid().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lists)), length)
    known = known & (np.bincount(row, weights=values.is_null().to_numpy(zero_copy_only=False), minlength=len(lists)) == 0)
    x = np.zeros((len(lists), length.max(initial=0)))
    x[row, np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)] = pc.fill_null(values.cast(pa.float64()), 0.0).to_numpy()
    return x, length, known


def diversity(candidates: DataFrame) -> DataFrame:
    """qid, i, diversity: mean cosine distance to all of the question's candidates, itself included.

    The mean cosine is the dot product with the mean of all unit vectors, so there is no pair: one sum a question and
    dimension, whatever the size of its pool. A cosine with a zero vector is 1."""
    unit = candidates.select("qid", "i", V.doubles("embedding").alias("x"), V.norm("embedding").alias("norm"))
    unit = unit.select("qid", "i", F.when(F.col("norm") > 0, F.transform("x", lambda v: v / F.col("norm"))).alias("u"))
    sums = unit.select("qid", F.posexplode("u").alias("d", "v")).groupBy("qid", "d").agg(F.sum("v").alias("v"))
    whole = sums.groupBy("qid").agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "v"))), lambda s: s["v"]).alias("sum"))
    counts = unit.groupBy("qid").agg(F.count("*").alias("n"), F.count_if(F.col("u").isNull()).alias("zeros"))
    near = F.when(F.col("u").isNull(), F.lit(1.0)).otherwise((V.dot("u", "sum") + F.col("zeros")) / F.col("n"))
    return unit.join(counts.join(whole, "qid", "left"), "qid").select("qid", "i", (1 - near).alias("diversity"))


def energy(selected: DataFrame, beta: float = 0.3, gamma: float = 0.4, answer: str = "answer") -> DataFrame:
    """qid, e_ctx, e_emb, e_sim, objective of selected candidates (qid, i, ctx, sim, embedding, and the embedding of the
    question's answer). e_emb is over the pairs of the selected and the answer."""
    each = selected.groupBy("qid").agg(F.sum("ctx").alias("e_ctx"), V.harmonic_mean(F.col("sim")).alias("e_sim"))
    distances = pair_distances(selected).select("qid", "distance").unionByName(selected.select("qid", V.cosine_distance("embedding", answer).alias("distance")))
    pairs = distances.groupBy("qid").agg(V.harmonic_mean(F.col("distance")).alias("e_emb"))
    both = each.join(pairs, "qid", "left").na.fill({"e_emb": 0.0})
    return both.withColumn("objective", F.col("e_ctx") + beta * F.col("e_emb") - gamma * F.col("e_sim"))


def _objective(chosen, ctx, distance, sim, beta, gamma):
    """distance has the answer in the row after the candidates'."""
    def harmonic(v):
        return 0.0 if not len(v) or (v == 0).any() else len(v) / (1 / v).sum()

    pairs = np.array([distance[a, b] for a, b in combinations((*chosen, len(ctx)), 2)])
    return ctx[list(chosen)].sum() + beta * harmonic(pairs) - gamma * harmonic(sim[list(chosen)])


def _best(k: int, ctx: np.ndarray, distance: np.ndarray, sim: np.ndarray, beta: float, gamma: float) -> tuple[int, ...]:
    """The k of all candidates of the largest objective, ties (at 12 places) to the smallest places: branch and bound.
    Candidates are taken by falling ctx. A branch is left when it can't reach the best even if its other members had the
    largest ctx that remain, all other distances were the largest and all other similarities the smallest; the members
    that end a branch are tried all at once. Distances and similarities are not negative."""
    order = np.argsort(-ctx, kind="stable")
    c = ctx[order]
    with np.errstate(divide="ignore"):
        far, like, away = 1 / distance[np.ix_(order, order)], 1 / sim[order], 1 / distance[order, len(c)]
    m, pairs = len(c), k * (k + 1) // 2
    sums = np.concatenate([[0.0], np.cumsum(c)])
    #: The smallest inverse distance of a pair, the answer's included, and the largest inverse similarity from each place on.
    least_far = min(far[np.triu_indices(m, 1)].min(initial=np.inf), away.min())
    most_like = np.maximum.accumulate(like[::-1])[::-1]
    best, found = -np.inf, ()

    def value(total, inverse, alike):
        return total + beta * pairs / inverse - gamma * k / alike

    def grow(chosen: tuple[int, ...], total: float, inverse: float, alike: float) -> None:
        nonlocal best, found
        left = k - len(chosen)
        start = chosen[-1] + 1 if chosen else 0
        if left == 1:
            last = np.arange(start, m)
            v = np.round(value(total + c[last], inverse + away[last] + far[list(chosen)][:, last].sum(0), alike + like[last]), 12)
            top = v.max(initial=-np.inf)
            if top >= best:
                ties = [tuple(sorted(int(order[i]) for i in (*chosen, j))) for j in last[v == top]]
                found = min(ties if top > best else [found, *ties])
                best = top
            return
        known = len(chosen) * (len(chosen) + 1) // 2
        for i in range(start, m - left + 1):
            # Members from i on; their ctx falls with i, so later ones reach no more.
            bound = value(total + sums[i + left] - sums[i], inverse + (pairs - known) * least_far, alike + left * most_like[i])
            if bound < best - 1e-9:
                break
            own = inverse + away[i] + far[list(chosen), i].sum()
            bound = value(total + sums[i + left] - sums[i], own + (pairs - known - len(chosen) - 1) * least_far, alike + like[i] + (left - 1) * most_like[i + 1])
            if bound >= best - 1e-9:
                grow((*chosen, i), total + c[i], own, alike + like[i])

    grow((), 0.0, 0.0, 0.0)
    return found


#: Pools of no more candidates are searched with the distances of all their pairs at hand.
SMALL_POOL = 256


class _Apart:
    """The distances of vectors and of their answer (the last one), made when they are asked for: memory goes with the
    pool, not with its pairs. A cosine with a zero vector is 1, and equal vectors are 0 apart whatever rounding leaves."""

    def __init__(self, x: np.ndarray) -> None:
        self.x, self.lengths = x, np.linalg.norm(x, axis=1)

    def row(self, i: int, others: slice | np.ndarray) -> np.ndarray:
        products = self.lengths[others] * self.lengths[i]
        with np.errstate(divide="ignore", invalid="ignore"):
            d = 1 - np.where(products == 0, 1.0, self.x[others] @ self.x[i] / products)
        return np.where(d < 1e-12, 0.0, d)

    def among(self, places: list[int]) -> np.ndarray:
        at = np.array(places)
        return np.array([self.row(i, at) for i in at])


def _best_apart(k: int, ctx: np.ndarray, x: np.ndarray, sim: np.ndarray, beta: float, gamma: float) -> tuple[int, ...]:
    """As _best, for pools whose pairs are too many to list; x are the candidates' vectors and the answer's.

    The same search, with a level's bounds computed for all its members at once and taken from the best bound down.
    The distances of a set are 1 - cos of unit vectors, and a sum of unit vectors has a length of 0 or more: the K
    members and the answer have a sum of distances of at most K^2 / 2, and less when those chosen already point
    one way. Of a fixed sum, equal distances have the least sum of inverses."""
    m, size, pairs = len(ctx), k + 1, k * (k + 1) // 2
    order = np.argsort(-ctx, kind="stable")
    c, apart = ctx[order], _Apart(np.concatenate([x[:-1][order], x[-1:]]))
    lengths = np.where(apart.lengths == 0, 1.0, apart.lengths)
    unit = apart.x / lengths[:, None]
    with np.errstate(divide="ignore"):
        like, away = 1 / sim[order], 1 / apart.row(m, slice(0, m))
    sums = np.concatenate([[0.0], np.cumsum(c)])
    most_like = np.append(np.maximum.accumulate(like[::-1])[::-1], 0.0)
    best, found = -np.inf, ()

    def value(total, inverse, alike):
        return total + beta * pairs / inverse - gamma * k / alike

    def offer(v: np.ndarray, chosen: tuple[int, ...], places: np.ndarray) -> None:
        nonlocal best, found
        v = np.round(v, 12)
        top = v.max(initial=-np.inf)
        if len(v) and top >= best:
            ties = [tuple(sorted(int(order[i]) for i in (*chosen, j))) for j in places[v == top]]
            found = min(ties if top > best or not found else [found, *ties])
            best = top

    def grow(chosen: tuple[int, ...], total: float, known: float, inverse: float, alike: float, inv: np.ndarray, whole: np.ndarray) -> None:
        """known and inverse: the sums of the distances so far and of their inverses; inv: for each place, the sum of its
        inverse distances to the answer and the chosen; whole: the sum of the unit vectors of these."""
        left, start = k - len(chosen), chosen[-1] + 1 if chosen else 0
        places = np.arange(start, m)
        if left == 1:
            offer(value(total + c[places], inverse + inv[places], alike + like[places]), chosen, places)
            return
        places = places[: m - start - left + 1]
        rest = left - 1
        # What the set has if each place comes next.
        near = unit[places] @ whole
        own = inverse + inv[places]
        n_known = (len(chosen) + 1) * (len(chosen) + 2) // 2
        seen = known + (len(chosen) + 1) - near
        length = np.sqrt(np.maximum(whole @ whole + 2 * near + 1, 0))
        most = pairs + (size - np.maximum(length - rest, 0) ** 2) / 2 - seen
        bound = total + sums[places + left] - sums[places]
        bound = value(bound, own + (pairs - n_known) ** 2 / np.maximum(most, 1e-9), alike + like[places] + rest * most_like[places + 1])
        for at in np.argsort(-bound, kind="stable"):
            if bound[at] < best - 1e-9:
                break
            i = int(places[at])
            with np.errstate(divide="ignore"):
                longer = inv.copy() if rest else inv
                longer[i + 1 :] += 1 / apart.row(i, slice(i + 1, m))
            grow((*chosen, i), total + c[i], float(seen[at]), float(own[at]), float(alike + like[i]), longer, whole + unit[i])

    with np.errstate(divide="ignore"):
        # A first best set from the most promising candidates, so that little is tried after it.
        alone = c + beta * np.minimum(1 / np.where(away > 0, away, 1), 2) - gamma * np.where(np.isinf(like), 0, 1 / like)
        head = np.sort(np.argsort(-alone, kind="stable")[: min(m, 64)])
        first = _best(k, c[head], apart.among([*head.tolist(), m]), sim[order][head], beta, gamma)
        best = float(np.round(_objective(tuple(range(k)), c[head[list(first)]], apart.among([*head[list(first)].tolist(), m]), sim[order][head[list(first)]], beta, gamma), 12)) - 1e-11
        grow((), 0.0, 0.0, 0.0, 0.0, away, unit[m])
    return found


def select_candidates(candidates: DataFrame, k: int = 3, beta: float = 0.3, gamma: float = 0.4, iterations: int = 100, exact: bool = False, seed: int = 0) -> DataFrame:
    """qid, slot, i: k of each question's candidates (qid, i, ctx, sim, embedding, answer) by simulated annealing of the energy
    (with the distances to the answer, an embedding that is no candidate; the last state is the result), or by a search that misses no subset. Draws depend on the question and the seed alone.

    A question's pool is one group; its memory goes with the pool. Distances are made when a state asks for them."""

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i", kind="stable")
        m, qid = len(pdf), pdf["qid"].iloc[0]
        ctx, sim = pdf["ctx"].to_numpy(float), pdf["sim"].to_numpy(float)
        x = np.array([*pdf["embedding"], pdf["answer"].iloc[0]], dtype=float)
        names = pdf["i"].to_numpy()
        del pdf
        apart = _Apart(x)
        state = tuple(range(min(k, m)))
        if m > k and exact:
            state = _best(k, ctx, apart.among([*range(m + 1)]), sim, beta, gamma) if m <= SMALL_POOL else _best_apart(k, ctx, x, sim, beta, gamma)
        elif m > k:

            def value(s: tuple[int, ...]) -> float:
                own = list(s)
                return _objective(tuple(range(k)), ctx[own], apart.among([*own, m]), sim[own], beta, gamma)

            rng = np.random.default_rng([seed, abs(hash(int(qid))) % (1 << 32)])
            for step in range(iterations):
                heat = 1 - step / iterations
                at, new = int(rng.integers(k)), int(rng.integers(m - k))
                for taken in sorted(state):  # the new-th place of those that are free
                    new += taken <= new
                other = (*state[:at], new, *state[at + 1 :])
                gain = value(other) - value(state)
                if gain > 0 or np.exp(max(gain / heat, -50)) > rng.random():
                    state = other
        return pd.DataFrame({"qid": qid, "slot": range(1, len(state) + 1), "i": names[list(state)]})

    return candidates.groupBy("qid").applyInPandas(choose, "qid long, slot int, i long")


def weighted_rank(candidates: DataFrame, n: int = 3) -> DataFrame:
    """The n best a question of candidates (qid, i, score, word_sim, sentence_sim, same_tag) by the weighted sum of
    scaled features: 0.6, 0.15, 0.15, 0.1."""
    w = Window.partitionBy("qid")
    scaled = lambda c: V.min_max_or_zero(F.col(c), F.min(c).over(w), F.max(c).over(w))
    total = 0.6 * scaled("score") + 0.15 * (1 - scaled("word_sim")) + 0.15 * (1 - scaled("sentence_sim")) + 0.1 * F.col("same_tag").cast("int")
    ranked = candidates.withColumn("total", total).withColumn("rank", F.row_number().over(w.orderBy(F.desc(F.round("total", 9)), "i")))
    return ranked.where(F.col("rank") <= n)


def set_quality(chosen: DataFrame) -> DataFrame:
    """qid, phi, capital_phi, delta: log mean sentence probability, minus log mean passage probability, summed distance."""
    means = chosen.groupBy("qid").agg(F.log(F.avg("p_sentence")).alias("phi"), (-F.log(F.avg("p_passage"))).alias("capital_phi"))
    far = pair_distances(chosen).groupBy("qid").agg(F.sum("distance").alias("delta"))
    return means.join(far, "qid", "left").na.fill({"delta": 0.0})


def shuffled(options: Column | str, qid: Column | str, seed: str = "shuffle") -> Column:
    """Options in a random order that the seed, the question and the options fix."""
    keyed = F.transform(X.col(options), lambda o: F.struct(F.md5(F.concat_ws("|", F.lit(seed), X.col(qid).cast("string"), o)).alias("h"), o.alias("o")))
    return F.transform(F.array_sort(keyed), lambda x: x["o"])


def inserted_answer(options: Column | str, answer: Column | str, qid: Column | str, seed: str = "slot") -> tuple[Column, Column]:
    """Three options with the answer put in one of four places, and the letter of that place."""
    place = (X.hashed(seed, qid) % 4).cast("int")
    return F.array_insert(X.col(options), place + 1, X.col(answer)), F.substr(F.lit("ABCD"), place + 1, F.lit(1))


def final_options(answer: Column, distractors: Column, qid: Column, failed: Column, n: int = 3) -> Column:
    """Answer and distractors shuffled; a failed row has the answer and n blanks."""
    return F.when(failed, F.concat(F.array(answer), F.array_repeat(F.lit(""), n))).otherwise(shuffled(F.concat(F.array(answer), distractors), qid))


def blank_eligible(word: Column, position: Column, used: Column | None = None, stopword: Column | None = None) -> Column:
    out = (word != "") & ~F.lower(word).isin("a", "an") & ~F.substring(word, 1, 1).rlike(r"\p{Lu}") & ~word.rlike("[0-9]") & ~word.rlike(r"[!\"#$%&()*+,./:;<=>?@\[\\\]^_`{|}~]")
    if used is not None:
        out = out & ~used
    return out & ~stopword if stopword is not None else out


def greedy_blanks(positions: DataFrame, count: int = 3, spacing: int = 4) -> DataFrame:
    """id, position: up to `count` positions of highest score that lie `spacing` apart, of positions (id, position,
    score); greedy, ties to the smaller position. A fold over each text's ranked positions, in the JVM."""
    ranked = positions.groupBy("id").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "position"))).alias("r"))
    near = lambda acc, p: F.exists(acc, lambda q: F.abs(q - p) < spacing)
    fold = F.aggregate("r", F.array().cast("array<bigint>"), lambda acc, x: F.when((F.size(acc) < count) & ~near(acc, x["position"]), F.array_append(acc, x["position"].cast("bigint"))).otherwise(acc))
    return ranked.select("id", F.explode(F.array_sort(fold)).alias("position"))


def cloze(words: Column, blanks: Column, mask: str = "_") -> Column:
    """Words in a line with those at the blanks (from 0) replaced."""
    return F.array_join(F.transform(words, lambda w, i: F.when(F.array_contains(blanks, i.cast("bigint")), F.lit(mask)).otherwise(w)), " ")


def position_scores(candidates: DataFrame, top: int = 64) -> DataFrame:
    """id, position, score: sigmoid of a thousandth of the sum of the `top` largest log ratios at each position."""
    w = Window.partitionBy("id", "position").orderBy(F.desc("ratio"))
    best = candidates.withColumn("k", F.row_number().over(w)).where(F.col("k") <= top)
    return best.groupBy("id", "position").agg(V.sigmoid(F.sum("ratio") / 1000).alias("score"))


def softmax(rows: DataFrame, by: list[str], x: str) -> DataFrame:
    """rows with p, the softmax of x within `by`, shifted by the maximum."""
    w = Window.partitionBy(*by)
    e = F.exp(F.col(x) - F.max(x).over(w))
    return rows.withColumn("__e", e).withColumn("p", F.col("__e") / F.sum("__e").over(w)).drop("__e")


def context_window(sentences: Column, at: Column, least_words: int) -> Column:
    """The sentence at `at` (from 0), widened by next and previous ones in turn until it has least_words words."""
    state = F.struct(at.alias("lo"), at.alias("hi"))
    count = lambda s: F.aggregate(F.slice(sentences, s["lo"] + 1, s["hi"] - s["lo"] + 1), F.lit(0), lambda a, x: a + X.word_count(x))

    def widen(s, k):
        lo = F.when((k % 2 == 1) | (s["hi"] >= F.size(sentences) - 1), F.greatest(s["lo"] - 1, F.lit(0))).otherwise(s["lo"])
        hi = F.when((k % 2 == 0) | (s["lo"] <= 0), F.least(s["hi"] + 1, F.size(sentences) - 1)).otherwise(s["hi"])
        return F.when(count(s) >= least_words, s).otherwise(F.struct(lo.alias("lo"), hi.alias("hi")))

    last = F.aggregate(F.sequence(F.lit(0), F.greatest(F.size(sentences) - 1, F.lit(0))), state, widen)
    return F.array_join(F.slice(sentences, last["lo"] + 1, last["hi"] - last["lo"] + 1), " ")
