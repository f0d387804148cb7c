"""The generation flow as a stream, and work in steps that a restart goes on with.

A micro-batch writes its questions, its rows of the manifest and its progress each into a folder of its own number, in
place of what an earlier attempt may have left there; the counts of the balance are state of the same batch. So a batch
that is done again, after a crash at any place, leaves the same files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators import generation as G
from ..sources import sinks as S
from ..sources.books import exists
from .incremental import balanced_stream

MANIFEST = "file_name string, type string, isbn string"
PROGRESS = "isbn string, paragraphs long, questions long"


def _earlier(spark: SparkSession, path: str, schema: str, batch: int | None = None) -> DataFrame:
    """What batches before `batch` (all, if it is None) have written; empty if there is none."""
    if not exists(spark, path):
        return spark.createDataFrame([], f"{schema}, batch long")
    rows = spark.read.schema(f"{schema}, batch long").parquet(path)
    return rows if batch is None else rows.where(F.col("batch") < batch)


def sink(folder: str, templates: DataFrame, generate: G.Generate, texts: DataFrame | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function for assigned paragraphs; texts: paragraphs that have the texts of those that came without.
    The batch is run once, for what is kept of it; all else is read from there."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        put = lambda rows, what: rows.write.mode("overwrite").parquet(f"{folder}/{what}/batch={number}")
        put(batch, "assigned")
        rows = spark.read.schema(batch.schema).parquet(f"{folder}/assigned/batch={number}")
        rows = rows if texts is None else G.with_texts(rows, texts)
        columns = ["type", "isbn", "record"]
        known = _earlier(spark, f"{folder}/questions", G.SAVED, number).select(*columns)
        put(S.new_rows(G.asked(rows, templates, generate), known), "questions")
        # From here on the batch's own files are read, so completions are made once.
        own = spark.read.schema(G.SAVED).parquet(f"{folder}/questions/batch={number}")
        listed = _earlier(spark, f"{folder}/manifest", MANIFEST, number).drop("batch")
        put(S.new_rows(S.manifest_rows(own.select("type", "isbn").distinct()), listed), "manifest")
        done = spark.read.parquet(f"{folder}/assigned/batch={number}").groupBy("isbn").agg(F.count("*").alias("paragraphs"))
        put(done.join(own.groupBy("isbn").agg(F.count("*").alias("questions")), "isbn", "left").na.fill({"questions": 0}), "progress")

    return write


def generate_stream(paragraphs: DataFrame, templates: DataFrame, generate: G.Generate, folder: str, annotate=None, threshold: int = 10, texts: DataFrame | None = None):
    """Start the flow over a stream of paragraphs (G.PARAGRAPH) and return the running query, which ends when all that is
    there has been read. Books must come in order of position, cut into batches anywhere. texts: the same paragraphs to
    read again, as files; with them the fold of a book has no texts in it, without them it holds those of a batch."""
    scored = G.scored_paragraphs(paragraphs, annotate)
    scored, own = (scored, "text") if texts is None else (G.without_texts(scored), "key")
    rows = balanced_stream(scored, "isbn", "position", threshold, carry=["paragraph_id", "page", own])
    out = rows.writeStream.foreachBatch(sink(folder, templates, generate, texts))
    return out.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()


def questions(spark: SparkSession, folder: str) -> DataFrame:
    return _earlier(spark, f"{folder}/questions", G.SAVED).drop("batch")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return _earlier(spark, f"{folder}/manifest", MANIFEST).drop("batch")


def progress(spark: SparkSession, folder: str) -> DataFrame:
    """isbn, paragraphs, questions so far."""
    return _earlier(spark, f"{folder}/progress", PROGRESS).groupBy("isbn").agg(F.sum("paragraphs").alias("paragraphs"), F.sum("questions").alias("questions"))


def in_steps(rows: DataFrame, order: list[str], work: Callable[[DataFrame], DataFrame], folder: str, every: int, stop_after: int | None = None) -> DataFrame | None:
    """work(rows), done for `every` rows in order at a time; None if it was stopped before the end.

    Rows are ordered and written once, a folder a step. A step's result is written aside and then moved to
    `done/step=<n>`: the move commits the result and how far the work has come at once, so a run that finds steps done goes
    on behind them, and a step that broke off is done again. `stop_after` ends a run after so many steps of its own."""
    spark = rows.sparkSession
    if not exists(spark, f"{folder}/input/_SUCCESS"):
        number = (F.regexp_extract("__step", r"_(\d+)$", 1).cast("long") - 1).alias("step")
        numbered = S.chunked(rows, order, every, "step").withColumnRenamed("chunk", "__step")
        numbered.select(*rows.columns, number).write.mode("overwrite").partitionBy("step").parquet(f"{folder}/input")
    numbered = spark.read.schema(StructType([*rows.schema.fields, StructField("step", LongType())])).parquet(f"{folder}/input")
    steps = sorted(r["step"] for r in numbered.select("step").distinct().collect())
    own = 0
    for step in steps:
        if exists(spark, f"{folder}/done/step={step}"):
            continue
        if stop_after is not None and own >= stop_after:
            return None
        part = spark.read.schema(rows.schema).parquet(f"{folder}/input/step={step}")
        work(part).write.mode("overwrite").parquet(f"{folder}/doing/step={step}")
        S.move(spark, f"{folder}/doing/step={step}", f"{folder}/done/step={step}")
        own += 1
    return spark.read.parquet(f"{folder}/done").drop("step") if steps else work(rows)
