"""Queries of the masked-model path: stems, pools, beams, windows, pooling, and the flow, over conversations and documents.

Probabilities stand in for a model's: numbers that question and token fix, the same on any engine. The vocabulary is the
words of `benchmark`; a turn of a user is a question, with its second word as the answer.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.stem import stem
from ..operators import masked as M
from .base import query, sql_hash, sql_sentences, sql_stems, sql_words, table
from .choice_queries import _CAP, _LOW, _UP, plain_words

# --- stems ---------------------------------------------------------------------------------------------------------


_DOC_WORDS = f"SELECT DISTINCT regexp_replace(lower(unnest({sql_words('text')})), '[^a-z]', '', 'g') AS word FROM documents"


@query(f"WITH {sql_stems(_DOC_WORDS)} SELECT word, stem FROM stems WHERE word <> ''")
def word_stems(spark, sf_dir):
    """The stem of every distinct word of the documents (a to z)."""
    words = plain_words(table(spark, sf_dir, "documents")).distinct().where("text <> ''")
    return words.select(F.col("text").alias("word"), stem("text").alias("stem"))


# --- pools ---------------------------------------------------------------------------------------------------------

#: The pools of the queries are small, and candidates override a rule where their cosine to the answer is negative.
SIZE, UNLIKE = 8, 0.0


def numbered(spark, sf_dir):
    """token, word of the vocabulary: a bounded list, in code-point order."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(X.words("text")).alias("word"))
    return words.agg(F.array_sort(F.collect_set("word")).alias("w")).select(F.posexplode("w").alias("token", "word"))


def with_vectors(spark, sf_dir, rows):
    """rows (word) with vector: one of `embeddings`, which the word fixes."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    n = vectors.count()
    return rows.withColumn("vec_id", X.hashed("embed", F.lower("word")) % n).join(vectors, "vec_id", "left").drop("vec_id")


def vocabulary(spark, sf_dir):
    flags = {"suffix": F.col("token") % 11 == 3, "profane": F.col("token") % 13 == 5, "known": F.lit(False)}
    return M.vocabulary_of(with_vectors(spark, sf_dir, numbered(spark, sf_dir)).withColumns(flags))


def questions(spark, sf_dir):
    """qid, words, answer, passage, p_sentence, p_passage, vector of every turn of a user of four words or more."""
    turns = table(spark, sf_dir, "conversations").where("role = 'user'").select((F.col("conv_id") * 1000 + F.col("turn")).alias("qid"), X.words("text").alias("words")).where(F.size("words") >= 4)
    size = numbered(spark, sf_dir).count()
    each = F.sequence(F.lit(0), F.lit(size - 1))
    p = lambda a, b, m: F.transform(each, lambda t: (1 + (F.col("qid") * a + t * b) % m) / F.lit(float(m + 1)))
    passage = F.array_join(F.transform("words", lambda w, i: F.when(i == 1, "<mask>").otherwise(w)), " ")
    rows = turns.withColumns({"answer": F.get("words", F.lit(1)), "passage": passage})
    # Probabilities are as long as the vocabulary, so they come behind the join: none goes through a shuffle.
    rows = with_vectors(spark, sf_dir, rows.withColumn("word", F.col("answer"))).drop("word")
    return rows.withColumns({"p_sentence": p(131, 977, 997), "p_passage": p(61, 389, 991)})


_VECTOR = f"{sql_hash('embed', 'lower(word)')} % (SELECT count(*) FROM embeddings)"
_ISWORD = "regexp_matches(word, '^[a-zA-ZäöüßéèêçñóíÄÖÜÉÈÊÇÑÓÍ]+(-[a-zA-ZäöüßéèêçñóíÄÖÜÉÈÊÇÑÓÍ]+)*(''(t|nt|s|ll))?$')"
_IS_UPPER = f"(regexp_matches({{0}}, '{_UP}') AND NOT regexp_matches({{0}}, '{_LOW}'))"
_QUESTIONS = f"""
q AS (SELECT qid, words, words[2] AS answer, list_transform(words, lambda w, i: CASE WHEN i = 2 THEN '<mask>' ELSE lower(w) END) AS passage
 FROM (SELECT conv_id * 1000 + turn AS qid, {sql_words("text")} AS words FROM conversations WHERE role = 'user') WHERE len(words) >= 4),
voc AS (SELECT CAST(row_number() OVER (ORDER BY encode(word)) - 1 AS INTEGER) AS token, word FROM (SELECT DISTINCT unnest({sql_words("text")}) AS word FROM benchmark)),
{sql_stems("SELECT word FROM voc UNION SELECT answer FROM q")},
emb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
tok AS (SELECT token, word, stem, v, token % 11 = 3 AS suffix, token % 13 = 5 AS profane, {_ISWORD} AS known FROM voc JOIN stems USING (word) LEFT JOIN emb ON vec_id = {_VECTOR}),
asked AS (SELECT qid, words, answer, passage, stem AS answer_stem, v AS answer_v FROM (SELECT *, answer AS word FROM q) q JOIN stems USING (word) LEFT JOIN emb ON vec_id = {_VECTOR}),
p AS (SELECT qid, token, word, answer, passage, answer_stem, stem, suffix, profane, known, (1 + (qid * 131 + token * 977) % 997) / 998.0 AS p_sentence, (1 + (qid * 61 + token * 389) % 991) / 992.0 AS p_passage,
 list_cosine_similarity(v, answer_v) AS cosine FROM asked, tok),
placed AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(ln(CASE WHEN suffix THEN 0 ELSE p_sentence END + 1e-10) - 0.4 * ln(CASE WHEN suffix THEN 0 ELSE p_passage END + 1e-10), 9) DESC, token) AS place FROM p),
ruled AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY place) AS k, CASE WHEN length(word) < 2 THEN 'short' WHEN regexp_matches(left(word, 1), '{_UP}') <> regexp_matches(left(answer, 1), '{_UP}') THEN 'first letter'
 WHEN profane THEN 'profane' WHEN NOT known AND NOT list_contains(passage, lower(word)) THEN 'not a word' WHEN lower(word) = passage[1] OR lower(word) = passage[3] THEN 'neighbour' WHEN regexp_matches(word, '[0-9]') THEN 'digit' END AS why
 FROM placed WHERE {_IS_UPPER.format("word")} = {_IS_UPPER.format("answer")}),
scan AS (SELECT qid, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS taken, [answer_stem] AS used, false AS took, CAST(NULL AS VARCHAR) AS reason FROM asked
 UNION ALL SELECT qid, k, taken + CAST(took AS BIGINT), CASE WHEN reason IS NULL THEN list_append(used, stem) ELSE used END, took, reason
 FROM (SELECT *, why IS NULL AND NOT list_contains(used, stem) OR cosine < {UNLIKE} AS took, coalesce(why, CASE WHEN list_contains(used, stem) THEN 'stem' END) AS reason
  FROM (SELECT s.qid, r.k, s.taken, s.used, r.stem, r.why, r.cosine FROM scan s JOIN ruled r ON s.qid = r.qid AND r.k = s.k + 1 WHERE s.taken < {SIZE}))),
pools AS (SELECT s.qid, CAST(taken AS INTEGER) AS slot, token, word, CAST(place AS INTEGER) AS place, s.reason, p_sentence, p_passage FROM scan s JOIN ruled r ON s.qid = r.qid AND s.k = r.k WHERE took)"""


@query(f"WITH RECURSIVE {_QUESTIONS} SELECT qid, slot, token, word, place, reason, round(p_sentence, 9) AS p_sentence, round(p_passage, 9) AS p_passage FROM pools")
def mask_pool(spark, sf_dir):
    """Candidates for the mask in each question, scanned from the vocabulary until a pool is full."""
    found = M.mask_pools(questions(spark, sf_dir), vocabulary(spark, sf_dir), SIZE, unlike=UNLIKE)
    return found.withColumns({c: F.round(c, 9) for c in ("p_sentence", "p_passage")})


_LEXICON = f"SELECT DISTINCT word FROM (SELECT regexp_replace(lower(unnest({sql_words('text')})), '[^a-z]', '', 'g') AS word FROM benchmark) WHERE word <> ''"
_MIXED = "list_transform(list_sort(list_transform(list_concat([answer], distractors), lambda o: {'h': md5('shuffle|' || qid || '|' || o), 'o': o})), lambda z: z.o)"


def _pairs(*names: str) -> str:
    """The harmonic mean of the distances of all pairs of these vectors."""
    d = [f"d_{a}{b}" for i, a in enumerate(names) for b in names[i + 1 :]]
    return f"CASE WHEN least({', '.join(d)}) = 0 THEN 0 ELSE {len(d)} / ({' + '.join(f'1 / {x}' for x in d)}) END"


def _apart(a: str, b: str) -> str:
    return f"(CASE WHEN 1 - list_cosine_similarity({a}, {b}) < 1e-12 THEN 0 ELSE 1 - list_cosine_similarity({a}, {b}) END)"


@query(f"""WITH RECURSIVE {_QUESTIONS},
lex AS (SELECT word, row_number() OVER (ORDER BY {sql_hash("fallback", "word")}, word) - 1 AS place FROM ({_LEXICON})),
few AS (SELECT qid, answer, {sql_hash("fallback", "qid")} % (SELECT count(*) FROM lex) AS start FROM q WHERE (SELECT count(*) FROM pools WHERE pools.qid = q.qid AND q.qid % 5 > 0) < 3),
extra AS (SELECT qid, {_CAP.format("word")} AS word FROM (SELECT qid, answer, (start + step) % (SELECT count(*) FROM lex) AS place FROM few, (SELECT unnest(range(0, 6)) AS step)) JOIN lex USING (place) WHERE lower(word) <> lower(answer)),
olds AS (SELECT qid, unnest(words[3:5]) AS word, unnest(range(1, len(words[3:5]) + 1)) AS pos, answer FROM q),
every AS (SELECT qid, 0 AS kind, slot AS pos, word, p_sentence, p_passage FROM pools WHERE qid % 5 > 0 UNION ALL SELECT qid, 1, row_number() OVER (PARTITION BY qid ORDER BY word), word, 0.5, 1.5 FROM extra
 UNION ALL SELECT qid, 2, row_number() OVER (PARTITION BY qid ORDER BY pos), word, 1, 1 FROM olds WHERE word <> '' AND word <> answer),
once AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY kind, pos) AS i FROM (SELECT *, row_number() OVER (PARTITION BY qid, word ORDER BY kind, pos) AS again FROM every) WHERE again = 1),
rated AS (SELECT o.*, v, answer_v, ln(greatest(p_sentence, 1e-10)) - 0.4 * ln(greatest(p_passage, 1e-10)) AS raw, list_cosine_similarity(v, answer_v) AS cosine FROM once o JOIN asked USING (qid) LEFT JOIN emb ON vec_id = {_VECTOR}),
scaled AS (SELECT *, (raw - min(raw) OVER w) / (max(raw) OVER w - min(raw) OVER w + 1e-10) AS ctx, (cosine - min(cosine) OVER w) / (max(cosine) OVER w - min(cosine) OVER w + 1e-10) AS sim FROM rated WINDOW w AS (PARTITION BY qid)),
threes AS (SELECT a.qid, a.i AS i, b.i AS j, c.i AS k, a.ctx + b.ctx + c.ctx AS e_ctx, CASE WHEN least(a.sim, b.sim, c.sim) = 0 THEN 0 ELSE 3 / (1 / a.sim + 1 / b.sim + 1 / c.sim) END AS e_sim,
 {_apart("a.v", "b.v")} AS d_ab, {_apart("a.v", "c.v")} AS d_ac, {_apart("b.v", "c.v")} AS d_bc, {_apart("a.v", "a.answer_v")} AS d_ax, {_apart("b.v", "a.answer_v")} AS d_bx, {_apart("c.v", "a.answer_v")} AS d_cx
 FROM scaled a JOIN scaled b ON a.qid = b.qid AND a.i < b.i JOIN scaled c ON a.qid = c.qid AND b.i < c.i),
best AS (SELECT qid, arg_min([i, j, k], (-round(e_ctx + 0.3 * {_pairs("a", "b", "c", "x").replace("d_xa", "d_ax")} - 0.4 * e_sim, 12), i, j, k)) AS chosen FROM threes GROUP BY qid),
d AS (SELECT q.qid, answer, (SELECT list(word ORDER BY i) FROM once o WHERE o.qid = q.qid) AS pool, chosen FROM q LEFT JOIN best USING (qid)),
f AS (SELECT qid, answer, coalesce(pool, []) AS pool, CASE WHEN len(pool) >= 3 THEN list_transform(chosen, lambda x: pool[x]) WHEN qid % 2 = 0 THEN list_filter(['alpha', 'beta', 'gamma'], lambda s: s <> answer) ELSE coalesce(pool, []) END AS distractors FROM d)
SELECT qid, answer, pool, distractors, {_MIXED} AS options FROM f""")
def masked_flow(spark, sf_dir):
    """From probabilities at a mask to final options; every fifth question has no probabilities, so its pool comes from the
    lexicon and its existing options."""
    none = F.lit(None).cast("array<double>")
    asked = questions(spark, sf_dir).withColumns({
        "p_sentence": F.when(F.col("qid") % 5 > 0, F.col("p_sentence")).otherwise(none), "existing": F.slice("words", 3, 3), "completion": F.lit(None).cast("string"),
        "fallback": F.when(F.col("qid") % 2 == 0, "alpha, beta,gamma"),
    })
    lexicon = plain_words(table(spark, sf_dir, "benchmark")).where("text <> ''").distinct().withColumnRenamed("text", "word")
    return M.masked_flow(asked, vocabulary(spark, sf_dir), lexicon, lambda rows: with_vectors(spark, sf_dir, rows), size=SIZE, unlike=UNLIKE, exact=True)


# --- beams ---------------------------------------------------------------------------------------------------------

_PLAIN = f"SELECT DISTINCT regexp_replace(lower(unnest({sql_words('text')})), '[^a-z]', '', 'g') AS word FROM"
WIDTH, DEPTH = 3, 3


@query(f"""WITH words AS (SELECT DISTINCT word FROM ({_PLAIN} benchmark UNION ALL {_PLAIN} conversations)),
v AS (SELECT text, suffix, CAST(row_number() OVER (ORDER BY suffix, text) - 1 AS INTEGER) AS token FROM (
 SELECT DISTINCT left(word, 2) AS text, false AS suffix FROM ({_PLAIN} benchmark) WHERE length(word) >= 4 UNION
 SELECT DISTINCT substr(word, i, 2), true FROM ({_PLAIN} benchmark), (SELECT unnest(range(3, 12, 2)) AS i) WHERE length(word) >= 4 AND length(word) % 2 = 0 AND i < length(word))),
asked AS (SELECT DISTINCT c.qid, t.token AS start FROM (SELECT conv_id * 1000 + turn AS qid, regexp_replace(lower(unnest({sql_words("text")})), '[^a-z]', '', 'g') AS word FROM conversations WHERE role = 'user') c JOIN v t ON t.suffix AND right(c.word, 2) = t.text WHERE length(c.word) >= 6),
s1 AS (SELECT qid, start, [start] AS tokens, CAST([] AS BIGINT[]) AS path, text FROM asked JOIN v ON token = start),
""" + "".join(f"""p{i} AS (SELECT s.*, v.token, v.suffix, v.text AS piece, (qid * 7919 + list_sum(tokens) * 104729 + v.token * 1299709 + {i} * 15485863) % 1000003 / 1000003.0 AS p FROM s{i} s, v),
r{i} AS (SELECT *, row_number() OVER (PARTITION BY qid, start, path, suffix ORDER BY p DESC, token) - 1 AS rank FROM p{i}),
f{i} AS (SELECT qid, start, path, arg_min(p, rank) AS p, arg_min(list_concat([token], tokens), rank) AS tokens FROM r{i} JOIN words ON word = piece || text WHERE NOT suffix AND rank < {WIDTH} GROUP BY qid, start, path),
s{i + 1} AS (SELECT qid, start, list_concat([token], tokens) AS tokens, list_append(path, rank) AS path, piece || text AS text FROM r{i} WHERE suffix AND rank < {WIDTH}),
""" for i in range(1, DEPTH + 1)) + f"""e AS ({" UNION ALL ".join(f"SELECT * FROM f{i}" for i in range(1, DEPTH + 1))}),
b AS (SELECT qid, start, arg_min(tokens, (-p, path)) AS tokens, max(p) AS p FROM e WHERE p > 0 GROUP BY qid, start)
SELECT a.qid, a.start, coalesce(tokens, []) AS tokens, round(coalesce(p, 0), 9) AS p FROM asked a LEFT JOIN b ON a.qid = b.qid AND a.start = b.start""")
def beam_suffixes(spark, sf_dir):
    """Words that end in the last two letters of a longer word of a question, grown to the left by a beam over two-letter
    pieces of the vocabulary."""
    plain = lambda name: plain_words(table(spark, sf_dir, name)).distinct().withColumnRenamed("text", "word")
    listed = plain("benchmark").where(F.length("word") >= 4)
    heads = listed.select(F.substring("word", 1, 2).alias("text"), F.lit(False).alias("suffix"))
    even = listed.where(F.length("word") % 2 == 0).select("word", F.explode(F.array(*map(F.lit, range(3, 12, 2)))).alias("i")).where(F.col("i") < F.length("word"))
    tails = even.select(F.substring("word", F.col("i"), F.lit(2)).alias("text"), F.lit(True).alias("suffix"))
    # A vocabulary of two-letter pieces: 2 * 26^2 at most.
    pieces = [(r["text"], r["suffix"]) for r in heads.unionByName(tails).distinct().orderBy("suffix", "text").collect()]
    number = F.create_map(*[F.lit(x) for i, (t, s) in enumerate(pieces) if s for x in (t, i)])
    turns = plain_words(table(spark, sf_dir, "conversations").where("role = 'user'"), (F.col("conv_id") * 1000 + F.col("turn")).alias("qid")).withColumnRenamed("text", "word")
    asked = turns.where(F.length("word") >= 6).select("qid", number[F.substring("word", -2, 2)].alias("start")).where("start IS NOT NULL").distinct().withColumn("depth", F.lit(DEPTH))
    each = F.sequence(F.lit(0).cast("long"), F.lit(len(pieces) - 1).cast("long"))
    added = F.aggregate("tokens", F.lit(0).cast("long"), lambda a, x: a + x)

    def score(states):
        own = F.col("qid") * 7919 + added * 104729 + F.col("step") * 15485863
        return states.withColumn("p", X.once(own, lambda base: F.transform(each, lambda t: (base + t * 1299709) % 1000003 / F.lit(1000003.0))))

    return M.beam_suffixes(asked, pieces, plain("benchmark").unionByName(plain("conversations")), score, WIDTH).withColumn("p", F.round("p", 9))


# --- windows and pooling -------------------------------------------------------------------------------------------


@query(f"""WITH RECURSIVE s AS (SELECT doc_id, {sql_sentences("text")} AS s FROM documents),
n AS (SELECT doc_id, len(s) AS size, list_transform(s, lambda x: len({sql_words("x")})) AS n FROM s WHERE len(s) > 0),
w AS (SELECT doc_id, size, CAST(unnest(range(0, size)) AS BIGINT) AS pos, unnest(n) AS own FROM n),
g AS (SELECT doc_id, size, pos, pos AS lo, pos AS hi, own AS words, 0 AS k FROM w
 UNION ALL SELECT g.doc_id, g.size, g.pos, CASE WHEN right_ THEN lo ELSE lo - 1 END, CASE WHEN right_ THEN hi + 1 ELSE hi END, words + w.own, k + 1
 FROM (SELECT *, hi < size - 1 AND (k % 2 = 0 OR lo = 0) AS right_ FROM g WHERE words < 20 AND hi - lo + 1 < size) g JOIN w ON w.doc_id = g.doc_id AND w.pos = CASE WHEN right_ THEN hi + 1 ELSE lo - 1 END)
SELECT doc_id, CAST(pos AS INTEGER) AS sentence, CAST(arg_max(lo, k) AS INTEGER) AS first, CAST(arg_max(hi, k) AS INTEGER) AS last, CAST(max(words) AS INTEGER) AS n_words FROM g GROUP BY doc_id, pos""")
def sentence_windows(spark, sf_dir):
    """Round every sentence of the documents the window of 20 words or more."""
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), X.sentences("text").alias("sentences"))
    return M.sentence_windows(texts, 20).select(F.col("key").alias("doc_id"), F.col("at").alias("sentence"), F.col("lo").alias("first"), F.col("hi").alias("last"), F.col("n_words").cast("int").alias("n_words"))


@query(f"""WITH t AS (SELECT doc_id, {sql_words("text")} AS t FROM documents), m AS (SELECT doc_id, t, CAST(unnest(list_filter(range(0, len(t)), lambda i: regexp_matches(t[i + 1], '[0-9]'))) AS INTEGER) AS mask_at FROM t),
d AS (SELECT *, CASE WHEN mask_at >= 64 THEN CAST(ceil((mask_at - 63) / 10.0) * 10 AS INTEGER) ELSE 0 END AS dropped FROM m)
SELECT doc_id, mask_at, dropped, mask_at - dropped AS mask_in, CAST(len(t[dropped + 1:dropped + 64]) AS INTEGER) AS n_tokens, md5(array_to_string(t[dropped + 1:dropped + 64], ' ')) AS digest FROM d""")
def mask_windows(spark, sf_dir):
    """The tokens that a model of 64 tokens gets for each token with a digit, as a mask, of every document."""
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), X.words("text").alias("tokens"))
    found = M.mask_windows(texts, lambda t: t.rlike("[0-9]"), limit=64, step=10)
    return found.select(F.col("key").alias("doc_id"), "mask_at", "dropped", "mask_in", F.size("window").alias("n_tokens"), F.md5(F.array_join("window", " ")).alias("digest"))


@query("""WITH x AS (SELECT label, vec_id, vec_id % 3 AS mask, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), u AS (SELECT label, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS d FROM x WHERE mask <> 0)
SELECT label, CAST(d AS BIGINT) AS d, round(avg(x), 6) AS mean FROM u GROUP BY label, d""")
def masked_pooling(spark, sf_dir):
    """The mean of a label's vectors, two of three of them, as a model's hidden states under an attention mask."""
    rows = table(spark, sf_dir, "embeddings").groupBy("label").agg(F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))).alias("x"))
    pooled = rows.select("label", F.posexplode(M.masked_mean(F.transform("x", lambda r: r["embedding"]), F.transform("x", lambda r: r["vec_id"] % 3))).alias("p", "mean"))
    return pooled.select("label", (F.col("p") + 1).cast("long").alias("d"), F.round("mean", 6).alias("mean"))
