"""Queries of the generation flow as a batch and as a stream, of work that goes on after a stop, and of the balance over
one scope of any size. Completions stand in for a model's: a fixed body a type, about the paragraph's id."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import extract as E
from ..functions import lexicons as L
from ..functions import text as X
from ..operators import generation as G
from ..operators import questions as Q
from ..session import shared_folder
from ..sources import sinks as S
from ..streaming import generation as T
from .base import query, sql_any, sql_hash, table
from .extract_queries import BODIES
from .flow_queries import _CLEAN, _TEMPLATES
from .text_queries import _FEATURES, _sql_scores
from .vector_queries import _CHOICE, _COUNTED, _N, arrivals_of


def paragraphs(spark, sf_dir):
    """Every document with a text is a paragraph; its source is its book, its id its position."""
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL AND doc_id IS NOT NULL")
    return d.select(F.col("source").alias("isbn"), F.col("doc_id").cast("string").alias("paragraph_id"), F.col("n_chars").cast("string").alias("page"), F.col("doc_id").cast("long").alias("position"), "text")


def templates(spark):
    return spark.createDataFrame(list(_TEMPLATES.items()), "name string, template string")


def completed(rows):
    """Every eleventh completion lacks its answer's label, and gives no record."""
    body = F.lit(None).cast("string")
    for t in E.PARSERS:
        body = F.when(F.col("type") == t, F.replace(F.lit(BODIES[t]), F.lit("{t}"), F.concat(F.lit("about "), "paragraph_id"))).otherwise(body)
    broken = F.when(F.col("paragraph_id").cast("long") % 11 == 0, F.replace(body, F.lit("**Answer:**"), F.lit("Answer"))).otherwise(body)
    return rows.withColumn("completion", F.concat(F.lit(f"x {L.START_MARK} "), broken, F.lit(f" {L.END_MARK} y")))


def read_back(saved):
    field = lambda p: F.get_json_object("record", p)
    return saved.select("type", "isbn", field("$.source.paragraph_id").alias("paragraph_id"), field("$.question").alias("question"))


def sql_fold(rows: str) -> str:
    """CTEs r and f (scope, k, key, assigned) of the balanced fold over `rows` (scope, key, s_<category>, draw, flip)."""
    return f"""r AS (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY key) AS k FROM ({rows})),
f AS (SELECT scope, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS key, CAST(NULL AS VARCHAR) AS assigned, {", ".join(f"0 AS {n}" for n in _N.values())} FROM (SELECT DISTINCT scope FROM r)
 UNION ALL SELECT scope, k, key, chosen || CASE WHEN chosen IN ('short', 'multi_hop') AND flip = 0 THEN '_inverse' ELSE '' END, {_COUNTED}
 FROM (SELECT r.scope, r.k, r.key, r.flip, {", ".join("f." + n for n in _N.values())}, {_CHOICE} AS chosen FROM f JOIN r ON r.scope = f.scope AND r.k = f.k + 1))"""


_SCORES = ", ".join(f"{s} AS s_{c}" for c, s in _sql_scores().items() if c in L.CATEGORIES)
_FOLDED = f"""feat AS (SELECT *, source AS scope, doc_id AS key FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
{_FEATURES.replace("f AS (SELECT doc_id,", "feats AS (SELECT doc_id, source,")},
{sql_fold(f"SELECT source AS scope, doc_id AS key, {_SCORES}, {sql_hash('draw', 'source', 'doc_id')} AS draw, {sql_hash('flip', 'source', 'doc_id')} % 2 AS flip FROM feats WHERE text IS NOT NULL AND doc_id IS NOT NULL AND n_words >= 15 AND ns >= 2 AND NOT {sql_any('low', L.IRRELEVANT)}")}"""
_FOLDED = _FOLDED.partition(",\n")[2]
_ASKS = {"short": "'What of ' || t || '?'", "short_inverse": "'Q ' || t", "tf": "t", "list": "'List ' || t", "mc": "'Which ' || t", "multi_hop": "'Why ' || t", "multi_hop_inverse": "'Why ' || t"}
_RECORDS = f"""WITH RECURSIVE {_FOLDED}
SELECT assigned AS type, scope AS isbn, CAST(key AS VARCHAR) AS paragraph_id, CASE assigned {" ".join(f"WHEN '{t}' THEN {q}" for t, q in _ASKS.items())} END AS question
FROM (SELECT *, 'about ' || key AS t FROM f WHERE k > 0 AND key % 11 <> 0)"""


@query(_RECORDS)
def generate_batch(spark, sf_dir):
    """Gate, types, balance, prompts, completions and records of all documents at once."""
    return read_back(G.generated(paragraphs(spark, sf_dir), templates(spark), completed))


def streamed(spark, sf_dir, folder: str, parts: int = 3) -> None:
    """The flow over the paragraphs in order of position, cut into parts, each a start of the stream on one checkpoint."""
    rows = paragraphs(spark, sf_dir)
    edges = rows.approxQuantile("position", [i / parts for i in range(1, parts)], 0.01)
    part = F.lit(0)
    for e in edges:
        part = part + F.when(F.col("position") > e, 1).otherwise(0)
    rows.withColumn("part", part).write.partitionBy("part").parquet(f"{folder}/staged")
    for i in range(parts):
        S.move(spark, f"{folder}/staged/part={i}", f"{folder}/in/{i}")
        source = spark.readStream.schema(rows.schema).parquet(f"{folder}/in/*")
        texts = spark.read.schema(rows.schema).parquet(f"{folder}/in/*")
        T.generate_stream(source, templates(spark), completed, folder, texts=texts).awaitTermination()


@query(_RECORDS)
def generate_flow(spark, sf_dir):
    """The same as a stream that is stopped and started anew twice: the balance is state, batches append what is new."""
    folder = shared_folder(spark, "generate")
    streamed(spark, sf_dir, folder)
    return read_back(T.questions(spark, folder))


@query(f"""WITH RECURSIVE {_FOLDED}, m AS (SELECT scope, count(*) AS paragraphs, count(*) FILTER (WHERE key % 11 <> 0) AS questions FROM f WHERE k > 0 GROUP BY scope),
n AS (SELECT scope, count(DISTINCT assigned) AS files FROM f WHERE k > 0 AND key % 11 <> 0 GROUP BY scope)
SELECT scope AS isbn, paragraphs, questions, coalesce(files, 0) AS files FROM m LEFT JOIN n USING (scope)""")
def generate_progress(spark, sf_dir):
    """What the stream has kept of its progress and its manifest: paragraphs, questions and files a book."""
    folder = shared_folder(spark, "generate")
    streamed(spark, sf_dir, folder)
    files = T.manifest(spark, folder).groupBy("isbn").agg(F.count("*").alias("files"))
    return T.progress(spark, folder).join(files, "isbn", "left").na.fill({"files": 0})


@query(f"SELECT doc_id, CASE WHEN text IS NOT NULL THEN {_CLEAN.format('text')} END AS text FROM documents")
def resumed_flow(spark, sf_dir):
    """Documents cleaned of references in five steps: a run that stops after two, and one that goes on where it stopped."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    every, folder = max(1, math.ceil(rows.count() / 5)), shared_folder(spark, "resumed")
    work = lambda part: part.withColumn("text", F.when(F.col("text").isNotNull(), X.clean_references("text")))
    if T.in_steps(rows, ["doc_id"], work, folder, every, stop_after=2) is None:
        return T.in_steps(rows, ["doc_id"], work, folder, every)
    return work(rows)  # fewer rows than steps


@query(f"""WITH RECURSIVE {sql_fold(f"SELECT 0 AS scope, c_custkey AS key, {', '.join(f'{sql_hash(c, "c_custkey")} % 6 AS s_{c}' for c in L.CATEGORIES)}, {sql_hash('draw', 'c_custkey')} AS draw, {sql_hash('flip', 'c_custkey')} % 2 AS flip FROM customer")}
SELECT key AS c_custkey, assigned FROM f WHERE k > 0""")
def balance_one_scope(spark, sf_dir):
    """All customers in one scope, as where one count runs through all books: the fold passes from range to range."""
    customers = table(spark, sf_dir, "customer").select(F.lit(0).alias("user_id"), F.col("c_custkey").alias("event_id"))
    return Q.balanced_ranges(arrivals_of(customers), "scope", "event_id").select(F.col("event_id").alias("c_custkey"), "assigned")
