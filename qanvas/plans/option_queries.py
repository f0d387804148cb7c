"""Queries of the whole multiple-choice flows, over benchmark items."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import flows as W
from .base import query, sql_hash, sql_strip, sql_words, table
from .choice_queries import _COMPLETION, _GREEDY, _UP, _completions

_MIXED = "list_transform(list_sort(list_transform(list_concat([answer], distractors), lambda o: {'h': md5('shuffle|' || qid || '|' || o), 'o': o})), lambda z: z.o)"


@query(rf"""WITH {_COMPLETION}, l AS (SELECT qid, answer, {sql_strip("x[i]")} AS c, i FROM (SELECT qid, answer, x, unnest(range(1, len(x) + 1)) AS i FROM (
 SELECT qid, answer, regexp_extract_all(completion, '(?m)^[ \t]*\d+[.)]?[ \t]*(.+)', 1) AS x FROM c))),
f AS (SELECT * FROM l WHERE c <> '' AND lower(c) <> lower(answer) AND NOT regexp_matches(lower(c), '^(answer:|correct)') AND NOT regexp_matches(lower(c), '^(distractor|option) [0-9]') AND NOT ends_with(c, '?')),
e AS (SELECT qid, unnest(w[4:6]) AS c, unnest(range(1, len(w[4:6]) + 1)) AS i, answer FROM (SELECT item_id AS qid, w, w[1] AS answer FROM (SELECT item_id, {sql_words("replace(text, 'ß', 's')")} AS w FROM benchmark) WHERE len(w) >= 4 AND item_id % 3 > 0)),
p AS (SELECT qid, c, i, 0 AS kind FROM f UNION ALL SELECT qid, c, i, 1 FROM e WHERE c <> '' AND c <> answer),
k AS (SELECT *, row_number() OVER (PARTITION BY qid, lower({sql_strip("c")}) ORDER BY kind, i) AS rn FROM p),
g AS (SELECT qid, list(c ORDER BY kind, i) AS pool FROM k WHERE rn = 1 GROUP BY qid),
a AS (SELECT c.qid, c.answer, coalesce(g.pool, []) AS pool, CASE WHEN c.qid % 2 = 0 THEN (list_filter(['alpha', 'beta', 'gamma', 'delta'], lambda s: lower(s) <> lower(c.answer)))[1:3] ELSE [] END AS parts FROM c LEFT JOIN g USING (qid)),
d AS (SELECT qid, answer, pool, CASE WHEN len(pool) >= 3 THEN pool[1:3] WHEN len(parts) > 0 THEN parts ELSE pool END AS distractors FROM a)
SELECT qid, answer, pool, distractors, CASE WHEN len(distractors) = 0 THEN [answer, '', '', ''] ELSE {_MIXED} END AS options FROM d""")
def mc_flow(spark, sf_dir):
    """From a model's completion to final options: candidates, existing options, fallback, shuffle."""
    w = X.words(F.replace("text", F.lit("ß"), F.lit("s")))
    existing = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.when(F.col("item_id") % 3 > 0, F.slice(w, 4, 3)).otherwise(F.array().cast("array<string>")).alias("existing"))
    fallback = F.when(F.col("qid") % 2 == 0, F.concat(F.upper("answer"), F.lit(", alpha,beta , gamma,delta")))
    return W.finished(W.distractors(_completions(spark, sf_dir).join(existing, "qid").withColumn("fallback", fallback)))


_PUNCTUATED = r"""[!"#$%&()*+,./:;<=>?@\[\\\]^_`{|}~]"""


@query(rf"""WITH RECURSIVE t AS (SELECT item_id AS id, {sql_words("text")} AS words FROM benchmark),
w AS (SELECT id, words, words[p + 1] AS word, p AS position, {sql_hash("blank", "id", "p")} % 1000 AS score FROM (SELECT id, words, unnest(range(0, len(words))) AS p FROM t)),
e AS (SELECT * FROM w WHERE lower(word) NOT IN ('a', 'an') AND NOT regexp_matches(left(word, 1), '{_UP}') AND NOT regexp_matches(word, '[0-9]') AND NOT regexp_matches(word, '{_PUNCTUATED}')),
scored AS (SELECT id, position, score FROM (SELECT *, row_number() OVER (PARTITION BY id, word ORDER BY score DESC, position) AS again FROM e) WHERE again = 1),
{_GREEDY},
a AS (SELECT b.id, b.position, words[b.position + 1] AS answer, list_transform([1, 2, 3], lambda k: words[(b.position + k) % len(words) + 1]) AS d, {sql_hash("slot", "b.id || ':' || b.position")} % 4 AS p FROM blanks b JOIN t USING (id)),
o AS (SELECT id, {{'position': position, 'options': list_concat(list_concat(d[1:p], [answer]), d[p + 1:3]), 'letter': substr('ABCD', CAST(p AS INTEGER) + 1, 1)}} AS b, position FROM a),
l AS (SELECT id, list(b ORDER BY position) AS blanks, list(position) AS holes FROM o GROUP BY id)
SELECT t.id, array_to_string(list_transform(words, lambda x, i: CASE WHEN list_contains(holes, i - 1) THEN '_' ELSE x END), ' ') AS cloze, coalesce(list_transform(blanks, lambda b: b.position), []) AS positions, coalesce(list_transform(blanks, lambda b: b.options), []) AS options, coalesce(list_transform(blanks, lambda b: b.letter), []) AS letters FROM t LEFT JOIN l USING (id) WHERE len(words) > 0""")
def cloze_test(spark, sf_dir):
    """Blanks, distractors (the words behind a blank, from the front again at the end) and letters of every item."""
    texts = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), X.words("text").alias("words")).where(F.size("words") > 0)
    positions = texts.select("id", F.posexplode("words").alias("position", "w"))
    scores = positions.select("id", "position", (X.hashed("blank", "id", "position") % 1000 / 1000.0).alias("score"))
    after = F.transform(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda k: F.get("words", ((F.col("position") + k) % F.size("words")).cast("int")))
    made = W.cloze_test(texts, scores, lambda asked: asked.withColumn("distractors", after))
    field = lambda name: F.transform("blanks", lambda b: b[name])
    return made.select("id", "cloze", field("position").alias("positions"), field("options").alias("options"), field("letter").alias("letters"))
