"""Streams run over the tables as they are, to the end, and held against the batch result."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from ..streaming.incremental import append_batches, balanced_stream
from .base import ORACLES, query, table
from .vector_queries import arrivals_of


def stream(spark: SparkSession, sf_dir: str, name: str):
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{sf_dir}/{name}.parque[t]"), schema


@query(ORACLES["balance_fold"])
def stream_balance(spark, sf_dir):
    """The balanced assignment with its counts as state."""
    events, _ = stream(spark, sf_dir, "events")
    folder = shared_folder(spark, "stream-balance")
    rows = balanced_stream(arrivals_of(events), "scope", "event_id")
    run = rows.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("scope", "event_id", "assigned")


@query("SELECT DISTINCT text, lang FROM documents")
def stream_dedup(spark, sf_dir):
    """The idempotent append over micro-batches: the stream goes in twice, its rows once."""
    folder = shared_folder(spark, "stream-dedup")
    for turn in (1, 2):
        docs, _ = stream(spark, sf_dir, "documents")
        rows = docs.select("text", "lang")
        sink = append_batches(f"{folder}/out", rows.schema)
        run = rows.writeStream.foreachBatch(sink).option("checkpointLocation", f"{folder}/state{turn}").trigger(availableNow=True).start()
        run.awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("text", "lang")


@query("""SELECT time_bucket(INTERVAL '1 hour', ts) AS hour, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY ALL""")
def stream_counts(spark, sf_dir):
    """Progress counts by hour of arrival, all hours in each result (complete mode), so the state is as large as the result: one row
    an hour and type. Use append mode with a watermark where that is unbounded."""
    events, _ = stream(spark, sf_dir, "events")
    folder = shared_folder(spark, "stream-counts")
    timed = events.withColumn("t", F.col("ts").cast("timestamp"))
    counts = timed.groupBy(F.window("t", "1 hour"), "event_type").agg(F.count("*").alias("n"))
    latest = counts.select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "event_type", "n")
    run = latest.writeStream.outputMode("complete").foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{folder}/out")).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(f"{folder}/out")
