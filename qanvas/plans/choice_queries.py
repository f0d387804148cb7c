"""Queries of multiple-choice repair, masking, candidates and options, over benchmark words and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import text as X
from ..functions.stem import stem
from ..operators import choices as C
from .base import query, sql_hash, sql_sentences, sql_stems, sql_strip, sql_words, table

_WORD = "regexp_replace(lower(w), '[^a-z]', '', 'g')"
#: Four options from the first words of an item; the answer is the first of them.
_OPTIONS = f"""
i AS (SELECT item_id AS qid, list_transform({sql_words("text")}[1:5], lambda w: {_WORD}) AS options FROM benchmark),
m AS (SELECT qid, options, options[1] AS answer FROM i WHERE options[1] <> '')"""


def items(spark, sf_dir):
    w = F.transform(F.slice(X.words("text"), 1, 5), lambda x: F.regexp_replace(F.lower(x), "[^a-z]", ""))
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), w.alias("options")).withColumn("answer", F.get("options", F.lit(0))).where("answer <> ''")


def plain_words(rows, *keys):
    """keys and text: a row for each word of rows (text), lowered, of the letters a to z."""
    return rows.select(*keys, F.explode(F.transform(X.words("text"), lambda x: F.regexp_replace(F.lower(x), "[^a-z]", ""))).alias("text"))


def item_words(spark, sf_dir):
    """All words of every item, as the texts that options and answers are made of."""
    return plain_words(table(spark, sf_dir, "benchmark"))


def all_words(spark, sf_dir):
    """All words of the documents and of every item."""
    return plain_words(table(spark, sf_dir, "documents")).unionByName(item_words(spark, sf_dir))


_ITEM_WORDS = f"SELECT unnest(list_transform({sql_words('text')}, lambda w: {_WORD})) AS text FROM benchmark"
_ALL_WORDS = f"SELECT DISTINCT text FROM ({_ITEM_WORDS} UNION ALL SELECT unnest(list_transform({sql_words('text')}, lambda w: {_WORD})) FROM documents) WHERE text <> ''"
#: Longer forms among all words of every item, found by comparing all pairs.
_FIX = f"""
t AS (SELECT DISTINCT text FROM ({_ITEM_WORDS}) WHERE text <> ''),
fix AS (SELECT a.text, max(b.text) AS longer FROM t a JOIN t b ON ends_with(b.text, a.text) AND length(b.text) - length(a.text) BETWEEN 1 AND 2 GROUP BY a.text)"""


@query(f"""WITH t AS ({_ALL_WORDS}), cut AS (SELECT text AS longer, unnest([substr(text, 2), substr(text, 3)]) AS text FROM t)
SELECT text, max(longer) AS longer FROM t JOIN cut USING (text) WHERE length(longer) > length(text) GROUP BY text""")
def suffix_repair(spark, sf_dir):
    """The longer form of every word of the documents and items that has one."""
    return C.suffix_map(all_words(spark, sf_dir))


@query(f"WITH {_FIX} SELECT text, longer FROM fix")
def suffix_repair_words(spark, sf_dir):
    """The longer form of every word of the items that has one."""
    return C.suffix_map(item_words(spark, sf_dir))


_CAP = "(CASE WHEN regexp_matches({0}, '^[a-zäöüßéèêçñóí]') THEN upper(left({0}, 1)) || lower(substr({0}, 2)) ELSE {0} END)"


@query(f"""WITH {_OPTIONS}, {_FIX},
o AS (SELECT qid, pos, {_CAP.format("coalesce(longer, o.text)")} AS text FROM (SELECT qid, unnest(options) AS text, unnest(range(1, len(options) + 1)) AS pos FROM m) o LEFT JOIN fix ON fix.text = o.text),
k AS (SELECT qid, min(pos) AS pos, arg_min(text, pos) AS text FROM o GROUP BY qid, lower({sql_strip("text")}))
SELECT m.qid, {_CAP.format("coalesce(longer, m.answer)")} AS answer, (SELECT list(text ORDER BY pos) FROM k WHERE k.qid = m.qid) AS options FROM m LEFT JOIN fix ON fix.text = m.answer""")
def mc_clean(spark, sf_dir):
    """Options and answers repaired by the longer forms among all words of every item."""
    return C.repaired(items(spark, sf_dir), item_words(spark, sf_dir))


#: Words within two edits leave a common rest when each loses up to two letters.
_LOSE = "list_transform(range(1, length({0}) + 1), lambda i: left({0}, i - 1) || substr({0}, i + 1))"


@query(f"""WITH t AS ({_ALL_WORDS}), one AS (SELECT text, unnest({_LOSE.format("text")}) AS k FROM t), two AS (SELECT text, unnest({_LOSE.format("k")}) AS k FROM (SELECT DISTINCT text, k FROM one)),
keys AS (SELECT text, text AS k FROM t UNION SELECT text, k FROM one UNION SELECT text, k FROM two),
near AS (SELECT DISTINCT a.text, b.text AS match FROM keys a JOIN keys b ON a.k = b.k AND a.text <> b.text),
rated AS (SELECT text, match, levenshtein(text, match) AS d FROM near)
SELECT text, arg_min(match, (d, match)) AS match FROM rated WHERE d <= 2 GROUP BY text""")
def close_match(spark, sf_dir):
    """The nearest other word within two edits of every word of the documents and items."""
    return C.close_match(all_words(spark, sf_dir))


@query(f"""WITH t AS (SELECT DISTINCT text FROM ({_ITEM_WORDS}) WHERE text <> '')
SELECT a.text, arg_min(b.text, (levenshtein(a.text, b.text), b.text)) AS match FROM t a JOIN t b ON a.text <> b.text AND levenshtein(a.text, b.text) <= 2 GROUP BY a.text""")
def close_match_words(spark, sf_dir):
    """The same over the words of the items; its SQL compares all pairs."""
    return C.close_match(item_words(spark, sf_dir))


@query("""WITH p AS (SELECT doc_id AS k, arg_min(text, doc_id) AS text FROM documents GROUP BY doc_id),
q AS (SELECT conv_id, turn, conv_id * 2 AS k FROM conversations WHERE role = 'user')
SELECT conv_id, turn, coalesce(replace(p.text, chr(10), ' '), '') AS passage FROM q LEFT JOIN p USING (k)""")
def qa_passage_lookup(spark, sf_dir):
    paragraphs = table(spark, sf_dir, "documents").select(F.lit("b").alias("isbn"), F.col("doc_id").cast("string").alias("paragraph_id"), F.col("doc_id").alias("position"), "text")
    asked = table(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", "turn", F.lit("b").alias("isbn"), (F.col("conv_id") * 2).cast("string").alias("paragraph_id"))
    return C.with_passage(asked, paragraphs).select("conv_id", "turn", "passage")


@query(f"""WITH b AS (SELECT item_id, text, {sql_words("text")} AS w FROM benchmark), x AS (SELECT item_id, text, w[2] || ' ' || w[3] AS answer FROM b WHERE len(w) >= 4)
SELECT item_id, replace('Which? ' || answer || ' ' || replace(text, chr(10), ' '), answer, '<mask> <mask>') AS masked FROM x""")
def mask_answer(spark, sf_dir):
    rows = table(spark, sf_dir, "benchmark").withColumn("w", X.words("text")).where(F.size("w") >= 4).withColumn("answer", F.concat_ws(" ", F.get("w", F.lit(1)), F.get("w", F.lit(2))))
    return rows.select("item_id", X.mask_answer(F.lit("Which?"), "answer", X.flat_passage("text"), "<mask>", F.lit(2)).alias("masked"))


_PUNCT = r"!\"#$%&''()*+,\-./:;<=>?@\[\\\]^_`{|}~"


@query(rf"""SELECT item_id, i, regexp_replace(w[i], '^([{_PUNCT}]*)([^{_PUNCT}](?:.*[^{_PUNCT}])?)([{_PUNCT}]*)$', '\1[MASK]\3') AS masked,
 regexp_matches(w[i], '^[^\W\d_]+(-[^\W\d_]+)*$') OR regexp_matches(w[i], '^[a-zA-ZäöüßéèêçñóíÄÖÜÉÈÊÇÑÓÍ]+(-[a-zA-ZäöüßéèêçñóíÄÖÜÉÈÊÇÑÓÍ]+)*(''(t|nt|s|ll))?$') AS is_word,
 coalesce(w[i - 1], '{L.BEFORE_TEXT}') AS before, coalesce(w[i + 1], '{L.AFTER_TEXT}') AS after
FROM (SELECT item_id, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT item_id, {sql_words("text")} AS w FROM benchmark))""")
def word_masks(spark, sf_dir):
    w = F.col("w")
    rows = table(spark, sf_dir, "benchmark").select("item_id", X.words("text").alias("w")).select("item_id", "w", F.posexplode("w").alias("p", "x"))
    near = lambda d, edge: F.coalesce(F.when(F.col("p") + d >= 0, F.get(w, F.col("p") + d)), F.lit(edge))
    return rows.select("item_id", (F.col("p") + 1).cast("long").alias("i"), X.mask_word("x").alias("masked"), X.is_word("x").alias("is_word"), near(-1, L.BEFORE_TEXT).alias("before"), near(1, L.AFTER_TEXT).alias("after"))


@query(f"""WITH b AS (SELECT item_id, {sql_words("text")} AS w FROM benchmark)
SELECT item_id, array_to_string(list_transform(w, lambda x, i: CASE WHEN i - 1 IN (2, 5, 9) THEN '_' ELSE x END), ' ') AS cloze FROM b""")
def cloze_render(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", C.cloze(X.words("text"), F.array(*[F.lit(i).cast("bigint") for i in (2, 5, 9)])).alias("cloze"))


_COMPLETION = f"""
c AS (SELECT item_id AS qid, w[1] AS answer, '1. ' || w[1] || chr(10) || '2) ' || w[2] || chr(10) || '3 ' || upper(w[2]) || chr(10) || 'note' || chr(10) || '4. Answer: x' || chr(10) || '5. ' || w[3] || '?' || chr(10) || '6.   ' || w[4] || chr(10) || '7. Option 2' AS completion
 FROM (SELECT item_id, {sql_words("replace(text, 'ß', 's')")} AS w FROM benchmark) WHERE len(w) >= 4)"""


def _completions(spark, sf_dir):
    w = F.col("w")
    at = lambda i: F.get(w, F.lit(i))
    text = F.concat(F.lit("1. "), at(0), F.lit("\n2) "), at(1), F.lit("\n3 "), F.upper(at(1)), F.lit("\nnote\n4. Answer: x\n5. "), at(2), F.lit("?\n6.   "), at(3), F.lit("\n7. Option 2"))
    return table(spark, sf_dir, "benchmark").select("item_id", X.words(F.replace("text", F.lit("ß"), F.lit("s"))).alias("w")).where(F.size("w") >= 4).select(F.col("item_id").alias("qid"), at(0).alias("answer"), text.alias("completion"))


@query(rf"""WITH {_COMPLETION}, l AS (SELECT qid, answer, x, {sql_strip("x[i]")} AS c, i FROM (SELECT qid, answer, x, unnest(range(1, len(x) + 1)) AS i FROM (
 SELECT qid, answer, regexp_extract_all(completion, '(?m)^[ \t]*\d+[.)]?[ \t]*(.+)', 1) AS x FROM c))),
f AS (SELECT * FROM l WHERE c <> '' AND lower(c) <> lower(answer) AND NOT regexp_matches(lower(c), '^(answer:|correct)') AND NOT regexp_matches(lower(c), '^(distractor|option) [0-9]') AND NOT ends_with(c, '?')),
k AS (SELECT qid, min(i) AS i, arg_min(c, i) AS candidate FROM f GROUP BY qid, lower(c))
SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY i) AS INTEGER) AS rank, candidate FROM k""")
def cand_filter_llm(spark, sf_dir):
    return C.listed_candidates(_completions(spark, sf_dir))


def _sql_first(n: int, items: str) -> str:
    return f"({items})[1:{n}]"


_PARTS = f"list_filter(list_transform(regexp_split_to_array(completion, '[\\n,;•\\-]+'), lambda s: {sql_strip('s')}), lambda s: s <> '' AND lower(s) <> lower(answer))"
_DISTINCT = f"list_transform(list_filter(list_zip({_PARTS}, range(1, len({_PARTS}) + 1)), lambda z: list_position({_PARTS}, z[1]) = z[2]), lambda z: z[1])"


@query(f"WITH {_COMPLETION} SELECT qid, {_sql_first(3, _DISTINCT)} AS split_, (list_filter(list_transform(string_split(completion, ','), lambda s: {sql_strip('s')}), lambda s: s <> '' AND s <> answer))[1:3] AS commas FROM c")
def cand_filter_delim(spark, sf_dir):
    return _completions(spark, sf_dir).select("qid", C.split_candidates("completion", "answer").alias("split_"), C.comma_candidates("completion", "answer").alias("commas"))


@query(f"""WITH {_COMPLETION}, d AS (SELECT qid, answer, CASE WHEN qid % 5 = 0 THEN 'Distractors:' ELSE 'x Distractors:' || chr(10) || '- aa' || chr(10) || '• bb ' || chr(10) || answer || ' cc' || chr(10) || completion END AS t FROM c),
k AS (SELECT qid, (list_filter(list_transform(string_split(string_split(t, 'Distractors:')[-1], chr(10)), lambda s: regexp_replace(s, '^[-•\\n ]+|[-•\\n ]+$', '', 'g')), lambda s: s <> '' AND NOT contains(lower(s), lower(answer))))[1:3] AS x FROM d)
SELECT qid, CASE WHEN len(x) > 0 THEN x ELSE ['Option A', 'Option B', 'Option C'] END AS options FROM k""")
def cand_filter_completion(spark, sf_dir):
    t = F.when(F.col("qid") % 5 == 0, "Distractors:").otherwise(F.concat(F.lit("x Distractors:\n- aa\n• bb \n"), "answer", F.lit(" cc\n"), "completion"))
    return _completions(spark, sf_dir).select("qid", C.completion_candidates(t, "answer").alias("options"))


_UP, _LOW = "[A-ZÄÖÜÉÈÊÇÑÓÍ]", "[a-zäöüßéèêçñóí]"


@query(f"""WITH b AS (SELECT item_id AS qid, {sql_words("text")} AS w FROM benchmark),
{sql_stems(f"SELECT DISTINCT unnest({sql_words('text')}) AS word FROM benchmark")},
x AS (SELECT qid, answer, i, y.word, stems.stem, a.stem AS answer_stem, length(y.word) % 10 / 10.0 AS sim FROM (SELECT qid, w[1] AS answer, i, w[i] AS word FROM (SELECT qid, w, unnest(range(2, len(w) + 1)) AS i FROM b)) y
 JOIN stems USING (word) JOIN stems a ON a.word = answer),
r AS (SELECT *, CASE WHEN (regexp_matches(word, '{_UP}') AND NOT regexp_matches(word, '{_LOW}')) <> (regexp_matches(answer, '{_UP}') AND NOT regexp_matches(answer, '{_LOW}')) THEN 'case'
 WHEN length(word) < 2 THEN 'short' WHEN regexp_matches(left(word, 1), '{_UP}') <> regexp_matches(left(answer, 1), '{_UP}') THEN 'first letter' WHEN lower(word) IN ('idiot', 'moron') THEN 'profane'
 WHEN lower(word) = 'the' OR lower(word) = 'of' THEN 'neighbour' WHEN regexp_matches(word, '[0-9]') THEN 'digit' WHEN stem = answer_stem THEN 'stem' END AS first FROM x),
y AS (SELECT qid, i, word, sim, coalesce(first, (SELECT min('stem') FROM r e WHERE e.qid = r.qid AND e.stem = r.stem AND e.i < r.i AND e.first IS NULL)) AS reason FROM r)
SELECT qid, i, word, reason, reason IS NULL OR (reason <> 'case' AND sim < 0.8) AS kept FROM y""")
def cand_filter_mlm(spark, sf_dir):
    """Words of an item as candidates for its first word."""
    rows = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), X.words("text").alias("w")).select("qid", "w", F.posexplode("w").alias("p", "word")).where("p > 0")
    answer, word = F.get("w", F.lit(0)), F.col("word")
    rows = rows.withColumns({"i": (F.col("p") + 1).cast("long"), "answer": answer, "stem": stem(word), "answer_stem": stem(answer)})
    reason = C.mask_candidate_reason(word, F.col("answer"), F.transform("w", F.lower), F.lit("the"), F.lit("of"), F.lit(False), F.lower("word").isin("idiot", "moron"), F.col("stem"), F.col("answer_stem"))
    return C.with_used_stems(rows.withColumn("reason", reason), "i").select("qid", "i", "word", "reason", C.mask_candidate_kept(F.col("reason"), F.length("word") % 10 / 10.0).alias("kept"))


@query(f"WITH {_OPTIONS} SELECT qid, list_filter(options, lambda o: o <> '' AND o <> answer) AS wrong FROM m")
def wrong_options(spark, sf_dir):
    return items(spark, sf_dir).select("qid", C.wrong_options("options", "answer").alias("wrong"))


_MIX = "list_transform(list_sort(list_transform(options, lambda o: {'h': md5('shuffle|' || qid || '|' || o), 'o': o})), lambda z: z.o)"


@query(f"""WITH {_OPTIONS}, s AS (SELECT *, {sql_hash("slot", "qid")} % 4 AS p FROM m)
SELECT qid, {_MIX} AS shuffled, list_concat(list_concat(options[1:p], [answer]), options[p + 1:3]) AS inserted, substr('ABCD', CAST(p AS INTEGER) + 1, 1) AS letter FROM s""")
def shuffle_options(spark, sf_dir):
    rows = items(spark, sf_dir)
    inserted, letter = C.inserted_answer(F.slice("options", 1, 3), "answer", "qid")
    return rows.select("qid", C.shuffled("options", "qid").alias("shuffled"), inserted.alias("inserted"), letter.alias("letter"))


@query(f"""WITH {_OPTIONS} SELECT qid, CASE WHEN qid % 7 = 0 THEN [answer, '', '', ''] ELSE
 list_transform(list_sort(list_transform(list_concat([answer], options[2:4]), lambda o: {{'h': md5('shuffle|' || qid || '|' || o), 'o': o}})), lambda z: z.o) END AS final FROM m""")
def final_options(spark, sf_dir):
    return items(spark, sf_dir).select("qid", C.final_options(F.col("answer"), F.slice("options", 2, 3), F.col("qid"), F.col("qid") % 7 == 0).alias("final"))


@query(rf"""SELECT item_id, i, w[i] <> '' AND lower(w[i]) NOT IN ('a', 'an') AND NOT regexp_matches(left(w[i], 1), '{_UP}') AND NOT regexp_matches(w[i], '[0-9]') AND NOT regexp_matches(w[i], '[!"#$%&()*+,./:;<=>?@\[\\\]^_`{{|}}~]') AS eligible
FROM (SELECT item_id, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT item_id, {sql_words("text")} AS w FROM benchmark))""")
def blank_eligible(spark, sf_dir):
    rows = table(spark, sf_dir, "benchmark").select("item_id", F.posexplode(X.words("text")).alias("p", "w"))
    return rows.select("item_id", (F.col("p") + 1).cast("long").alias("i"), C.blank_eligible(F.col("w"), F.col("p")).alias("eligible"))


_GREEDY = """ranked AS (SELECT id, position, row_number() OVER (PARTITION BY id ORDER BY score DESC, position) AS k FROM scored),
g AS (SELECT DISTINCT id, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS taken FROM ranked
 UNION ALL SELECT g.id, r.k, CASE WHEN len(list_filter(taken, lambda q: abs(q - r.position) < 4)) = 0 THEN list_append(taken, r.position) ELSE taken END FROM g JOIN ranked r ON r.id = g.id AND r.k = g.k + 1 WHERE len(taken) < 3),
blanks AS (SELECT id, unnest(taken) AS position FROM (SELECT id, arg_max(taken, k) AS taken FROM g GROUP BY id))"""


@query(f"""WITH RECURSIVE scored AS (SELECT id, position, {sql_hash("blank", "id", "position")} % 1000 AS score FROM (SELECT item_id AS id, unnest(range(0, len({sql_words("text")}))) AS position FROM benchmark)), {_GREEDY}
SELECT id, position FROM blanks""")
def greedy_blanks(spark, sf_dir):
    rows = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.posexplode(X.words("text")).alias("position", "w"))
    return C.greedy_blanks(rows.select("id", "position", (X.hashed("blank", "id", "position") % 1000 / 1000.0).alias("score")))


@query(f"""WITH b AS (SELECT item_id, text, CASE WHEN length(text) >= 300 THEN 1 ELSE CAST(ceil(301.0 / (length(text) + 1)) AS INTEGER) END AS n FROM benchmark)
SELECT item_id, array_to_string(list_transform(range(0, n), lambda i: text), ' ') AS tiled FROM b""")
def tiled_text(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", X.tiled("text", F.lit(300)).alias("tiled"))


@query(f"""WITH s AS (SELECT item_id, {sql_sentences("text")} AS s FROM benchmark), n AS (SELECT item_id, s, list_transform(range(1, len(s) + 1), lambda k: list_sum(list_transform(s[1:k], lambda x: len({sql_words("x")})))) AS n FROM s)
SELECT item_id, array_to_string(s[1:coalesce(list_min(list_filter(range(1, len(s) + 1), lambda k: n[k] >= 20)), len(s))], ' ') AS window FROM n""")
def context_windows(spark, sf_dir):
    """Round the first sentence of each item the window of 20 words or more."""
    return table(spark, sf_dir, "benchmark").select("item_id", C.context_window(X.sentences("text"), F.lit(0), 20).alias("window"))


@query(f"""WITH l AS (SELECT DISTINCT unnest({sql_words("text")}) AS w FROM benchmark), t AS (SELECT DISTINCT unnest({sql_words("text")}) AS w FROM conversations)
SELECT w, true AS in_lexicon FROM t JOIN l USING (w)""")
def lexicon_filter(spark, sf_dir):
    lexicon = table(spark, sf_dir, "benchmark").select(F.explode(X.words("text")).alias("w")).distinct()
    words = table(spark, sf_dir, "conversations").select(F.explode(X.words("text")).alias("w")).distinct()
    return words.join(lexicon, "w", "left_semi").select("w", F.lit(True).alias("in_lexicon"))
