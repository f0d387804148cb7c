"""Queries over documents: segmentation, gates, question types, prompts, books, sinks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import models as M
from ..functions import text as X
from ..operators import questions as Q
from ..sources import books as B
from ..sources import sinks as S
from .base import query, sql_any, sql_lines, sql_sentence_parts, sql_sentences, sql_strip, sql_words, table

_PARAGRAPHS = f"""
paragraphs AS (
    SELECT doc_id, CAST(i AS INTEGER) AS n, p[i] AS text
    FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM (SELECT doc_id, {sql_lines("text")} AS p FROM documents))
)"""


def paragraphs(spark, sf_dir):
    """documents as books: lines are paragraphs, all on page 1."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(X.paragraphs("text", "\n")).alias("i", "text"))
    return rows.select("doc_id", (F.col("i") + 1).cast("int").alias("n"), "text")


@query(f"""WITH {_PARAGRAPHS}
SELECT doc_id, doc_id || '-p1-para' || n AS paragraph_id, doc_id || '-p1' AS section, CAST(1 AS INTEGER) AS page, text FROM paragraphs""")
def para_split(spark, sf_dir):
    page = F.format_string("%d-p%d", "doc_id", F.lit(1))
    return paragraphs(spark, sf_dir).select("doc_id", F.concat(page, F.lit("-para"), F.col("n").cast("string")).alias("paragraph_id"), page.alias("section"), F.lit(1).alias("page"), "text")


@query(f"""SELECT doc_id, doc_id || '-p1-s' || i AS sentence_id, {sql_strip("s[i]")} AS text
FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, {sql_sentence_parts("text")} AS s FROM documents))
WHERE {sql_strip("s[i]")} <> ''""")
def sentence_split(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(X.sentence_parts("text")).alias("i", "s")).withColumn("text", X.strip("s"))
    return rows.where("text <> ''").select("doc_id", F.format_string("%d-p1-s%d", "doc_id", F.col("i") + 1).alias("sentence_id"), "text")


@query("SELECT doc_id, source FROM documents WHERE source <> '' AND doc_id IN (SELECT doc_id FROM labels)")
def catalog_validate(spark, sf_dir):
    catalog = table(spark, sf_dir, "documents").select("doc_id", "source", F.when(F.col("source") != "", F.col("doc_id").cast("string")).otherwise("").alias("file_link"))
    return B.valid_rows(catalog, table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("path"))).select("doc_id", "source")


@query(f"SELECT doc_id FROM documents WHERE len({sql_words('text')}) >= 15 AND len({sql_sentences('text')}) >= 2")
def gate_length(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(Q.length_gate("text")).select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE NOT {sql_any('lower(text)', L.IRRELEVANT)}")
def gate_keywords(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(Q.keyword_gate("text")).select("doc_id")


_LABELS = """list_filter([CASE WHEN regexp_matches(text, '[0-9]{4}') THEN 'DATE' END, CASE WHEN regexp_matches(text, '[A-Z][a-z]+ [A-Z][a-z]+') THEN 'PERSON' END,
 CASE WHEN regexp_matches(text, '[A-Z]{2,}') THEN 'ORG' END, CASE WHEN regexp_matches(text, '[a-z] [A-Z][a-z]+ [a-z]') THEN 'GPE' END], lambda v: v IS NOT NULL)"""


@query(rf"""SELECT doc_id, CASE WHEN len({sql_words("text")}) < 15 OR len({sql_sentences("text")}) < 2 THEN 'length'
 WHEN {sql_any("lower(text)", L.IRRELEVANT)} THEN 'keyword' WHEN regexp_matches(text, '([0-9]+\.[0-9]+|Fig\.|Table|•)') THEN 'figure'
 WHEN CAST(len({_LABELS}) AS DOUBLE) / len({sql_words("text")}) < 0.01 THEN 'density' END AS reason FROM documents""")
def gate_report(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", Q.reject_reason("text", M.pattern_labels("text"), figures=True).alias("reason"))


@query("SELECT doc_id, rn FROM (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rn FROM documents) WHERE rn >= 5 AND rn < 20")
def range_slice(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1).cast("long").alias("rn"))
    return rows.where("rn >= 5 AND rn < 20")


@query(f"WITH {_PARAGRAPHS} SELECT doc_id, CAST(count(*) AS BIGINT) AS n_paragraphs, string_agg(text, chr(10) ORDER BY n) AS joined FROM paragraphs GROUP BY doc_id")
def book_nest(spark, sf_dir):
    rows = paragraphs(spark, sf_dir).select(F.col("doc_id").alias("isbn"), F.lit("t").alias("title"), F.col("n").alias("position"), F.col("n").cast("string").alias("paragraph_id"), F.lit("s").alias("section"), F.lit(1).alias("page"), "text")
    return S.nested_books(rows).select(F.col("isbn").alias("doc_id"), F.size("paragraphs").cast("long").alias("n_paragraphs"), F.array_join("paragraphs.Text", "\n").alias("joined"))


@query(f"""WITH {_PARAGRAPHS} SELECT doc_id, n, text FROM paragraphs""")
def book_explode(spark, sf_dir):
    rows = paragraphs(spark, sf_dir).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("n", "text"))).alias("p"))
    return rows.select("doc_id", F.explode("p").alias("p")).select("doc_id", "p.n", "p.text")


_FEATURES = f"f AS (SELECT doc_id, text, lower(text) AS low, len({sql_words('text')}) AS n_words, len({sql_sentences('text')}) AS ns, {_LABELS} AS labels, len({_LABELS}) AS d, (length(text) % 100) / 100.0 AS e FROM documents)"


def _sql_points(*rules: tuple[str, int]) -> str:
    return " + ".join(f"(CASE WHEN {c} THEN {n} ELSE 0 END)" for c, n in rules)


def _sql_scores(k=2, o=4, m=2, w=3) -> dict[str, str]:
    short = _sql_points((sql_any("low", L.SHORT_WORDS), 1), ("e BETWEEN 0.3 AND 0.5", 1), ("d >= 1 AND ns > 1", 1), ("ends_with(text, '?')", 2))
    hop = _sql_points((sql_any("low", L.REASON_WORDS), 1), ("d > 3 AND ns > 3", 2), ("d > 1", 2), ("e > 0.5", 1))
    return {
        "short": short, "tf": _sql_points((sql_any("low", L.TRUTH_WORDS), 1), ("ns <= 2", 2), ("d = 0", 1), ("e < 0.3", 1)),
        "list": _sql_points((sql_any("low", L.LIST_WORDS), 1), ("regexp_matches(text, '[,;]')", 2), ("d > 2", 1)),
        "mc": _sql_points((sql_any("low", L.CHOICE_WORDS), k), ("regexp_matches(text, '[ABCD]:')", o), ("ns > 1 AND d > 1", m), ("contains(low, 'which of the following')", w)),
        "multi_hop": hop, "short_inverse": short, "multi_hop_inverse": hop,
    }


def _sql_best(scores: dict[str, str]) -> str:
    top = "greatest(" + ", ".join(scores[t] for t in L.TYPES if t in scores) + ")"
    return "CASE " + " ".join(f"WHEN {scores[t]} = {top} THEN '{t}'" for t in L.TYPES if t in scores) + " END"


def _annotated(spark, sf_dir):
    return M.annotated(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumn("low", F.lower("text"))


def scores_of(rows, **kw):
    return Q.type_scores("text", F.col("n_sentences"), F.col("labels"), F.col("entropy"), low=F.col("low"), **kw)


@query(f"WITH {_FEATURES} SELECT doc_id, " + ", ".join(f"CAST({s} AS INTEGER) AS {t}" for t, s in _sql_scores().items()) + " FROM f")
def type_scores(spark, sf_dir):
    rows = _annotated(spark, sf_dir)
    return rows.select("doc_id", *[s.cast("int").alias(t) for t, s in scores_of(rows).items()])


@query(f"WITH {_FEATURES} SELECT doc_id, {_sql_best(_sql_scores())} AS type FROM f")
def type_argmax(spark, sf_dir):
    rows = _annotated(spark, sf_dir)
    return rows.select("doc_id", Q.best_type(scores_of(rows)).alias("type"))


@query(f"WITH {_FEATURES} SELECT doc_id, {_sql_best({k: v for k, v in _sql_scores(1, 3, 1, 2).items() if not k.endswith('inverse')})} AS type FROM f")
def type_v3(spark, sf_dir):
    rows = _annotated(spark, sf_dir)
    five = {k: v for k, v in scores_of(rows, choice_points=(1, 3, 1, 2)).items() if not k.endswith("inverse")}
    return rows.select("doc_id", Q.best_type(five).alias("type"))


@query(rf"""SELECT doc_id, CASE WHEN regexp_matches(text, '•|,|;|and|or') AND len({sql_words("text")}) > 15 THEN 'list'
 WHEN regexp_matches(text, '(?i)({L.V1_CHOICE})') THEN 'mc'
 WHEN regexp_matches(text, '\b(\d{{4}}|\d{{1,2}}/\d{{1,2}}/\d{{2,4}}|[A-Z][a-z]+ [A-Z][a-z]+)\b') THEN 'short' ELSE 'tf' END AS type FROM documents""")
def type_v1(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", Q.first_type("text").alias("type"))


_V2 = {
    "short": _sql_points((f"list_has_any(labels, {L.NAMED_LABELS})", 2), ("e BETWEEN 0.3 AND 0.5", 1)), "tf": _sql_points(("e < 0.3", 1), ("ns <= 2", 1), ("d = 0", 1)),
    "list": _sql_points(("e > 0.5", 1), ("d > 2", 1), ("regexp_matches(text, '•|,|;|and|or')", 1)),
    "mc": _sql_points((f"regexp_matches(text, '(?i)({L.V2_CHOICE})')", 2), ("ns > 1 AND d > 1", 1), ("regexp_matches(text, '[ABCD]:')", 2)),
    "multi_hop": _sql_points((f"regexp_matches(text, '(?i)({L.V2_REASON})')", 2), ("d > 3 AND ns > 3", 1), ("d > 1", 1)),
}


@query(f"WITH {_FEATURES} SELECT doc_id, {_sql_best(_V2)} AS type FROM f")
def type_v2(spark, sf_dir):
    rows = _annotated(spark, sf_dir)
    return rows.select("doc_id", Q.best_type(Q.second_scores("text", F.col("n_sentences"), F.col("labels"), F.col("entropy"))).alias("type"))


@query(f"""WITH {_FEATURES}, kept AS (SELECT *, {_sql_best(_sql_scores())} AS type FROM f WHERE n_words >= 15 AND ns >= 2 AND NOT {sql_any("low", L.IRRELEVANT)})
SELECT type, CAST(count(*) AS BIGINT) AS n FROM kept GROUP BY type""")
def flagship(spark, sf_dir):
    """Scan, gate, annotate, score, argmax, count: native expressions and one small shuffle."""
    rows = M.annotated(table(spark, sf_dir, "documents").select("text").where(Q.length_gate("text") & Q.keyword_gate("text"))).withColumn("low", F.lower("text"))
    return rows.select(Q.best_type(scores_of(rows)).alias("type")).groupBy("type").agg(F.count("*").alias("n"))


@query(f"""WITH w AS (SELECT unnest({sql_words("lower(text)")}) AS word FROM documents)
SELECT word, CAST(count(*) AS BIGINT) AS n FROM w GROUP BY word""")
def word_freq(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.explode(X.words(F.lower("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


@query(f"""SELECT doc_id, replace('Read this. {{paragraph_text}} Now ask about: {{paragraph_text}}', '{{paragraph_text}}', text) AS prompt,
 CAST(least(len({sql_words("text")}), 512) AS INTEGER) AS input_length, CAST(least(256, 512 - least(len({sql_words("text")}), 512)) AS INTEGER) AS new_tokens FROM documents""")
def prompt_render(spark, sf_dir):
    templates = spark.createDataFrame([("short", f"Read this. {L.PLACEHOLDER} Now ask about: {L.PLACEHOLDER}")], "type string, template string")
    rows = table(spark, sf_dir, "documents").withColumn("type", F.lit("short")).join(F.broadcast(templates), "type")
    used, new = M.token_budget(M.estimated_tokens("text"), 512, 256)
    return rows.select("doc_id", F.replace("template", F.lit(L.PLACEHOLDER), F.col("text")).alias("prompt"), used.alias("input_length"), new.alias("new_tokens"))


@query("""SELECT text, lang FROM documents EXCEPT SELECT text, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)""")
def dedup_append(spark, sf_dir):
    """All documents arrive; the labelled ones are there already."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    known = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return S.new_rows(docs.drop("doc_id"), known.drop("doc_id"))


_PREFIXES = "CASE lang WHEN 'en' THEN 'short' WHEN 'fr' THEN 'TF' WHEN 'de' THEN 'multi_hop_inverse' ELSE 'MC' END"


@query(f"""WITH r AS (SELECT DISTINCT {_PREFIXES} || '_QA-' || source || '.json' AS file_name, source AS isbn FROM documents)
SELECT file_name, lower(string_split(file_name, '_')[1]) AS type, isbn FROM r""")
def manifest_upsert(spark, sf_dir):
    kind = F.when(F.col("lang") == "en", "short").when(F.col("lang") == "fr", "tf").when(F.col("lang") == "de", "multi_hop_inverse").otherwise("mc")
    rows = S.manifest_rows(table(spark, sf_dir, "documents").select(kind.alias("type"), F.col("source").alias("isbn")))
    return S.manifest_upsert(rows.where("isbn < 'src15'"), rows)


@query("SELECT doc_id, format('mc_chunk_{:03d}', CAST((row_number() OVER (ORDER BY doc_id) - 1) // 50 + 1 AS INTEGER)) AS chunk FROM documents")
def chunk_rows(spark, sf_dir):
    return S.chunked(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"])


@query("""SELECT 'documents' AS output, CAST(count(*) AS BIGINT) AS records FROM documents UNION ALL SELECT 'labels', CAST(count(*) AS BIGINT) FROM labels
UNION ALL SELECT 'benchmark', CAST(count(*) AS BIGINT) FROM benchmark""")
def report_counts(spark, sf_dir):
    return S.count_report({n: table(spark, sf_dir, n) for n in ("documents", "labels", "benchmark")})


@query("""SELECT CAST(count(*) FILTER (WHERE l.quality = 1) AS BIGINT) AS success, CAST(count(*) FILTER (WHERE l.quality IS DISTINCT FROM 1) AS BIGINT) AS skipped
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def success_skip(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return rows.agg(F.count_if(F.col("quality").eqNullSafe(1)).alias("success"), F.count_if(~F.col("quality").eqNullSafe(1)).alias("skipped"))


@query(r"""WITH b AS (SELECT item_id, 'It works according to Smith ' || item_id || ', in part.  ' || text AS question, CASE WHEN item_id % 3 = 0 THEN NULL ELSE 'According to the study, it works.' END AS answer FROM benchmark)
SELECT item_id, regexp_replace(regexp_replace(regexp_replace(question, '(?i)\baccording to\b[^,.!?;:]*[,.!?;:]\s*', '', 'g'), '\s{2,}', ' ', 'g'), '^\s+|\s+$', '', 'g') AS question,
 coalesce(regexp_replace(regexp_replace(regexp_replace(answer, '(?i)\baccording to\b[^,.!?;:]*[,.!?;:]\s*', '', 'g'), '\s{2,}', ' ', 'g'), '^\s+|\s+$', '', 'g'), '') AS answer FROM b""")
def clean_refs(spark, sf_dir):
    rows = table(spark, sf_dir, "benchmark").select(
        "item_id", F.concat(F.lit("It works according to Smith "), F.col("item_id").cast("string"), F.lit(", in part.  "), "text").alias("question"),
        F.when(F.col("item_id") % 3 != 0, "According to the study, it works.").alias("answer"),
    )
    return rows.withColumns({c: X.clean_references(c) for c in ("question", "answer")})
