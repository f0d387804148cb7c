"""Queries of scans and sinks through files in the shared folder, and of the steps between them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import choices as C
from ..operators import questions as Q
from ..session import shared_folder
from ..sources import books as B
from ..sources import sinks as S
from .base import query, sql_strip, sql_words, table


def _catalog(spark, sf_dir):
    """A catalog row a part: its brand as title, null now and then."""
    p = table(spark, sf_dir, "part")
    some = lambda c, k: F.when(F.col("p_partkey") % k != 0, c)
    return p.select(
        some(F.col("p_name"), 7).alias("Title"), some(F.concat(F.lit("10-"), "p_partkey"), 5).alias("ISBN-10"), F.concat(F.lit("978-"), "p_partkey").alias("ISBN-13"),
        some(F.concat(F.lit("/books/"), "p_partkey", F.lit(".pdf")), 3).alias("File Link"), some(F.concat(F.lit("json/"), "p_partkey", F.lit("_processed.json")), 4).alias("JSON File"),
    )


_CATALOG = """SELECT CASE WHEN p_partkey % 7 <> 0 THEN p_name ELSE 'Unknown Title' END AS title, CASE WHEN p_partkey % 5 <> 0 THEN '10-' || p_partkey ELSE 'Unknown ISBN-10' END AS isbn10,
 '978-' || p_partkey AS isbn13, CASE WHEN p_partkey % 3 <> 0 THEN '/books/' || p_partkey || '.pdf' ELSE '' END AS file_link"""


@query(f"{_CATALOG} FROM part")
def catalog_scan(spark, sf_dir):
    """A catalog written as CSV and scanned; one that is missing is an empty catalog."""
    folder = shared_folder(spark, "catalog")
    S.write_catalog(_catalog(spark, sf_dir).drop("JSON File"), folder)
    return B.catalog(spark, folder).unionByName(B.catalog(spark, f"{folder}-missing"))


@query(f"{_CATALOG}, CASE WHEN p_partkey % 4 <> 0 THEN 'json/' || p_partkey || '_processed.json' ELSE '' END AS json_file FROM part")
def processed_catalog_scan(spark, sf_dir):
    """The catalog that preprocessing leaves behind, with the book's JSON file."""
    folder = shared_folder(spark, "processed-catalog")
    S.write_catalog(_catalog(spark, sf_dir), folder)
    return B.catalog(spark, folder, processed=True)


@query("SELECT 'Brand#' || (o_orderkey % 10) AS isbn, CAST(o_orderkey AS VARCHAR) AS title FROM orders WHERE o_orderkey % 10 IN (1, 4)")
def catalog_by_isbn(spark, sf_dir):
    """A catalog file for each ISBN; two of them are read back by their folders alone."""
    folder = shared_folder(spark, "catalogs")
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("Brand#"), (F.col("o_orderkey") % 10).cast("string")).alias("isbn"), F.col("o_orderkey").cast("string").alias("title"))
    S.write_catalogs_by(rows, "isbn", folder)
    return spark.read.schema("title string, isbn string").option("header", True).csv(folder).where(F.col("isbn").isin("Brand#1", "Brand#4")).select("isbn", "title")


def _paragraphs(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1
    return d.select(F.col("source").alias("isbn"), F.concat(F.lit("T "), "source").alias("title"), place.alias("position"), F.col("doc_id").cast("string").alias("paragraph_id"), F.col("lang").alias("section"), F.col("n_chars").cast("int").alias("page"), "text")


@query("""WITH p AS (SELECT source AS isbn, 'T ' || source AS title, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS INTEGER) AS position,
 CAST(doc_id AS VARCHAR) AS paragraph_id, lang AS section, text FROM documents WHERE text IS NOT NULL)
SELECT isbn, title, position, paragraph_id, section, text FROM p""")
def book_files(spark, sf_dir):
    """Books written as JSON files, found by the pattern of their names, and joined with the catalog by ISBN; files of
    other names and files that are not JSON give nothing."""
    folder = shared_folder(spark, "books")
    paragraphs = _paragraphs(spark, sf_dir)
    S.write_books(S.nested_books(paragraphs), folder)
    B.write_text(spark, f"{folder}/file=notes/part-0.json", '{"ISBN": "none", "Title": "no book"}')
    B.write_text(spark, f"{folder}/file=bad_processed/part-0.json", "{not json")
    catalog = paragraphs.select(F.col("isbn").alias("isbn13")).distinct()
    found = B.books_of(catalog, B.books(spark, f"{folder}/file=*_processed"))
    return B.book_paragraphs(found).select("isbn", "title", "position", "paragraph_id", "section", "text")


@query(f"SELECT DISTINCT unnest({sql_words('text')}) AS word FROM (SELECT text FROM benchmark UNION ALL SELECT text FROM conversations WHERE turn = 1)")
def word_lists(spark, sf_dir):
    """Two lists of words in text files, as one set."""
    folder = shared_folder(spark, "words")
    table(spark, sf_dir, "benchmark").select(F.coalesce("text", F.lit("")).alias("value")).write.text(f"{folder}/a")
    table(spark, sf_dir, "conversations").where("turn = 1").select(F.coalesce("text", F.lit("")).alias("value")).write.text(f"{folder}/b")
    return B.word_list(spark, f"{folder}/a", f"{folder}/b")


@query("""WITH p AS (SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS INTEGER) AS page, replace(text, chr(12), ' ') AS text FROM documents WHERE text IS NOT NULL)
SELECT source, page, text FROM p WHERE regexp_matches(text, '[^ \n\r\t]')""")
def page_scan(spark, sf_dir):
    """Documents as the pages of a file a source, parted by form feeds, scanned page by page."""
    folder = shared_folder(spark, "pages")
    rows = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("source", "doc_id", F.translate("text", "\f", " ").alias("text"))
    rows.repartition("source").sortWithinPartitions("source", "doc_id").select("source", "text").write.partitionBy("source").option("lineSep", "\f").text(folder)
    pages = B.text_pages(spark, f"{folder}/source=*")
    return pages.select(F.regexp_extract("path", "source=([^/]+)/", 1).alias("source"), "page", "text")


_TEMPLATES = {t: f"Write a {t} question.\nText: {{paragraph_text}}\nAnswer:" for t in ("short", "tf", "list", "mc", "multi_hop", "short_inverse", "multi_hop_inverse")}
_NAMES = ", ".join(f"'{t}'" for t in _TEMPLATES)


@query(f"""SELECT doc_id, t.type, 'Write a ' || t.type || ' question.' || chr(10) || 'Text: ' || d.text || chr(10) || 'Answer:' AS prompt
FROM documents d JOIN (SELECT [{_NAMES}][1 + CAST(doc_id % 7 AS INTEGER)] AS type, doc_id FROM documents) t USING (doc_id)""")
def type_templates(spark, sf_dir):
    """Seven template files, joined with rows by question type, and rendered."""
    folder = shared_folder(spark, "templates")
    for name, template in _TEMPLATES.items():
        B.write_text(spark, f"{folder}/{name}.prompt", template)
    kinds = F.array(*map(F.lit, _TEMPLATES))
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", F.get(kinds, (F.col("doc_id") % 7).cast("int")).alias("type"))
    return Q.rendered(rows, B.templates(spark, folder)).select("doc_id", "type", "prompt")


@query("SELECT doc_id, lang AS type, text AS question FROM documents WHERE source < 'src15'")
def saved_output(spark, sf_dir):
    """Questions saved over an earlier file; the second save replaces the first, a missing file counts as empty."""
    folder = shared_folder(spark, "saved")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("type"), F.col("text").alias("question"), "source")
    S.overwrite_questions(rows.drop("source"), folder)
    S.overwrite_questions(rows.where("source < 'src15'").drop("source"), folder)
    schema = rows.drop("source").schema
    return B.saved_questions(spark, folder, schema).unionByName(B.saved_questions(spark, f"{folder}-missing", schema))


@query("SELECT DISTINCT lang || '_QA-' || source || '.json' AS file_name, lang AS type, source AS isbn FROM documents")
def manifest_scan(spark, sf_dir):
    """A manifest written as CSV and scanned with ISBNs as text; a missing one is empty."""
    folder = shared_folder(spark, "manifest")
    rows = table(spark, sf_dir, "documents").select(F.concat("lang", F.lit("_QA-"), "source", F.lit(".json")).alias("file_name"), F.col("lang").alias("type"), F.col("source").alias("isbn"))
    S.write_catalog(S.manifest_upsert(B.manifest(spark, f"{folder}-missing"), rows), folder)
    return B.manifest(spark, folder)


_CLEAN = r"""coalesce(regexp_replace(regexp_replace(regexp_replace({0}, '\baccording to\b[^,.!?;:]*[,.!?;:]\s*', '', 'gi'), '\s{{2,}}', ' ', 'g'), '^\s+|\s+$', '', 'g'), '')"""


@query(f"""WITH q AS (SELECT item_id, 'According to X, ' || text AS question, text AS answer, CASE WHEN item_id % 2 = 0 THEN 'so  according to Y; ' || text END AS incorrect_answer,
 CASE WHEN item_id % 3 = 0 THEN text END AS explanation FROM benchmark)
SELECT item_id, {_CLEAN.format("question")} AS question, {_CLEAN.format("answer")} AS answer, CASE WHEN incorrect_answer IS NOT NULL THEN {_CLEAN.format("incorrect_answer")} END AS incorrect_answer,
 CASE WHEN explanation IS NOT NULL THEN {_CLEAN.format("explanation")} END AS explanation FROM q""")
def cleaned_output(spark, sf_dir):
    """All four optional fields of saved questions cleaned of references, written as JSON, and read back; a field that a
    question lacks stays away."""
    b = table(spark, sf_dir, "benchmark")
    even, third = F.col("item_id") % 2 == 0, F.col("item_id") % 3 == 0
    q = b.select("item_id", F.concat(F.lit("According to X, "), "text").alias("question"), F.col("text").alias("answer"), F.when(even, F.concat(F.lit("so  according to Y; "), "text")).alias("incorrect_answer"), F.when(third, F.col("text")).alias("explanation"))
    folder = shared_folder(spark, "cleaned")
    S.overwrite_questions(Q.cleaned(q), folder)
    return B.saved_questions(spark, folder, q.schema)


@query(f"""WITH w AS (SELECT item_id AS qid, list_filter(list_transform({sql_words("text")}, lambda w: regexp_replace(lower(w), '[^a-z]', '', 'g')), lambda w: w <> '') AS w FROM benchmark)
SELECT 'fix_start' AS stage, qid, w[1] AS answer, len(w[1:4]) AS n_options FROM w WHERE len(w) > 0 UNION ALL
SELECT 'fix_distractor', qid, w[1], len(list_distinct(list_filter(w[1:4], lambda o: o <> w[1]))) + 1 FROM w WHERE len(w) > 0""")
def stage_outputs(spark, sf_dir):
    """The outputs of two stages by one write: items as they start, and with distinct distractors."""
    w = F.filter(F.transform(X.words("text"), lambda x: F.regexp_replace(F.lower(x), "[^a-z]", "")), lambda x: x != "")
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), w.alias("w")).where(F.size("w") > 0).select("qid", F.get("w", F.lit(0)).alias("answer"), F.slice("w", 1, 4).alias("options"))
    folder = shared_folder(spark, "stages")
    fixed = items.withColumn("options", F.concat(F.array("answer"), F.array_distinct(C.wrong_options("options", "answer"))))
    S.write_stages({"fix_start": items, "fix_distractor": fixed}, folder)
    parts = [spark.read.schema(items.schema).json(f"{folder}/stage={s}").withColumn("stage", F.lit(s)) for s in ("fix_start", "fix_distractor")]
    return parts[0].unionByName(parts[1]).select("stage", "qid", "answer", F.size("options").cast("long").alias("n_options"))


@query("""SELECT doc_id, coalesce(CASE WHEN doc_id % 3 > 0 THEN source END, 'Unknown ISBN') AS isbn, coalesce(CASE WHEN doc_id % 4 > 0 THEN lang END, 'Unknown Section') AS section,
 coalesce(CASE WHEN doc_id % 5 > 0 THEN CAST(n_chars AS VARCHAR) END, 'Unknown Page') AS page, coalesce(CASE WHEN doc_id % 4 > 0 THEN CAST(doc_id AS VARCHAR) END, 'Unknown ID') AS paragraph_id FROM documents""")
def source_struct(spark, sf_dir):
    """Where a question comes from, with defaults for what is unknown. The section stands beside the saved struct, which
    has the other three."""
    d = table(spark, sf_dir, "documents")
    some = lambda c, k: F.when(F.col("doc_id") % k > 0, F.col(c))
    rows = d.select("doc_id", some("source", 3).alias("isbn"), F.coalesce(some("lang", 4), F.lit("Unknown Section")).alias("section"), some("n_chars", 5).alias("page"), some("doc_id", 4).alias("paragraph_id"))
    return rows.select("doc_id", "section", Q.source_of("isbn", "page", "paragraph_id").alias("s")).select("doc_id", "s.isbn", "section", "s.page", "s.paragraph_id")


@query(f"""SELECT doc_id, CASE WHEN len({sql_words("text")}) > 64 THEN array_to_string({sql_words("text")}[1:64], ' ') ELSE text END AS prompt FROM documents""")
def prompt_truncated(spark, sf_dir):
    """A prompt is cut to the longest sequence only if it is over it; else it stays as it is."""
    return table(spark, sf_dir, "documents").select("doc_id", Q.truncated("text", 64).alias("prompt"))


@query(f"""WITH w AS (SELECT item_id AS qid, {sql_words("lower(text)")} AS w FROM benchmark), o AS (SELECT qid, w[1:6] AS fresh, w[4:9] AS existing FROM w)
SELECT qid, u.option, u.pos AS position FROM (SELECT qid, fresh, existing, unnest(list_transform(range(1, len(fresh) + 1), lambda i: {{'option': fresh[i], 'pos': i}})) AS u FROM o)
WHERE NOT list_contains(existing, u.option) AND list_position(fresh, u.option) = u.pos""")
def new_distractors(spark, sf_dir):
    """Ranked distractors without the options that a question has already, each once, in order."""
    w = X.words(F.lower("text"))
    o = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.slice(w, 1, 6).alias("fresh"), F.slice(w, 4, 6).alias("existing"))
    kept = o.select("qid", "fresh", F.explode(F.array_except("fresh", "existing")).alias("option"))
    return kept.select("qid", "option", F.array_position("fresh", F.col("option")).cast("long").alias("position"))


@query("""WITH p AS (SELECT vec_id AS qid, unnest(range(0, len(embedding))) AS token, unnest(embedding) AS logit FROM embeddings),
r AS (SELECT qid, token, row_number() OVER (PARTITION BY qid ORDER BY logit DESC, token) AS rank FROM p) SELECT qid, CAST(token AS INTEGER) AS token, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""")
def mask_top_k(spark, sf_dir):
    """The k likeliest tokens of a masked position, ties by token: within the row that has the scores, without a shuffle."""
    return C.top_tokens(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("logits")), 5)


@query(f"SELECT DISTINCT CAST(('0x' || substr(md5(w), 1, 8)) AS BIGINT) AS id, w AS word FROM (SELECT unnest({sql_words('lower(text)')}) AS w FROM benchmark)")
def vocabulary_by_id(spark, sf_dir):
    """A vocabulary in order of its ids, by ranges."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(X.words(F.lower("text"))).alias("word")).distinct()
    return words.select(F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("long").alias("id"), "word").orderBy("id", "word")


@query(f"""WITH o AS (SELECT item_id AS qid, unnest({sql_words("text")}[1:8]) AS word, unnest(range(1, len({sql_words("text")}[1:8]) + 1)) AS pos FROM benchmark),
x AS (SELECT qid, word, pos, 0 AS kind FROM o WHERE pos <= 5 UNION ALL SELECT qid, word, pos, 1 FROM o WHERE pos > 3),
k AS (SELECT *, row_number() OVER (PARTITION BY qid, lower({sql_strip("word")}) ORDER BY kind, pos) AS rn FROM x)
SELECT qid, word, CAST(kind AS INTEGER) AS existing FROM k WHERE rn = 1""")
def existing_folded(spark, sf_dir):
    """Existing wrong options folded into a pool: each text once by its lowered form, the pool's first."""
    w = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.posexplode(F.slice(X.words("text"), 1, 8)).alias("position", "word"))
    return C.with_existing(w.where("position < 5"), w.where("position >= 3")).select("qid", "word", "existing")


@query(f"""WITH k AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents WHERE len({sql_words("text")}) >= 15)
SELECT doc_id, source, CAST((rn - 1) // 4 AS BIGINT) AS batch, rn % 20 = 0 AS checkpoint FROM k WHERE rn > 5""")
def resumed_batches(spark, sf_dir):
    """Informative paragraphs from the sixth on, in batches of four, with a checkpoint at every twentieth; the last batch
    may be short, and is kept."""
    rows = table(spark, sf_dir, "documents").where(X.word_count("text") >= 15).select("doc_id", "source")
    return Q.batches_of(rows, "source", "doc_id", size=4, start=5, every=20).select("doc_id", "source", "batch", "checkpoint")


@query(f"""WITH t AS (SELECT conv_id, turn, list_transform({sql_words("text")}, lambda w: CAST(length(w) AS DOUBLE)) AS v FROM conversations WHERE len({sql_words("text")}) > 0),
s AS (SELECT conv_id, count(*) * max(len(v)) AS n, sum(list_sum(v)) AS s, sum(list_sum(list_transform(v, lambda x: x * x))) AS q FROM t GROUP BY conv_id),
m AS (SELECT conv_id, var_pop(list_avg(v)) AS pooled FROM t GROUP BY conv_id)
SELECT conv_id, CASE WHEN n > 1 THEN round((q - s * s / n) / (n - 1), 6) END AS coherence, round(pooled, 6) AS entropy FROM s JOIN m USING (conv_id)""")
def padded_coherence(spark, sf_dir):
    """Two variances of a text's sentences by tokens: the sample variance over the tensor padded with zeros to the longest
    sentence (the coherence gate), and the population variance over the sentences' means (the entropy of the types)."""
    t = table(spark, sf_dir, "conversations").select("conv_id", F.transform(X.words("text"), lambda w: F.length(w).cast("double")).alias("v")).where(F.size("v") > 0)
    return Q.sentence_variances(t, "conv_id").select("conv_id", F.round("coherence", 6).alias("coherence"), F.round("entropy", 6).alias("entropy"))
