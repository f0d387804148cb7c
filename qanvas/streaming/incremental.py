"""Streams: idempotent appends and balanced assignment over micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import lexicons as L
from ..operators.questions import Balance
from ..sources.books import exists
from ..sources.sinks import digest


#: Batches of no more rows send their digests (32 bytes each) to every task.
BROADCAST_ROWS = 250_000


def _indexed(spark: SparkSession, path: str, columns: list[str], existing: DataFrame) -> DataFrame:
    """canon: the digests of all records under a path, from an index beside the files, which readers pass over. Files that
    it lacks (those of the last batch; others after a crash) are read for it first, so a record is hashed once."""
    index = f"{path}/_digests"
    name = F.input_file_name()
    kind = "canon binary, file string"
    listed = {r["file"] for r in spark.read.schema(kind).parquet(index).select("file").distinct().collect()} if exists(spark, index) else set()
    missing = [f for f in existing.inputFiles() if f not in listed]
    if missing:
        rows = spark.read.schema(existing.schema).parquet(*missing)
        rows.select(digest(*columns).alias("canon"), name.alias("file")).write.mode("append").parquet(index)
    return spark.read.schema(kind).parquet(index).select("canon")


def append_batches(path: str, schema) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that appends what is new to Parquet files; replaying a batch adds nothing.

    A batch reads the digests of what is there, not the records, and they are held against its own without a shuffle;
    only records that are new are shuffled, once, for what a batch repeats itself."""

    def write(batch: DataFrame, _: int) -> None:
        spark: SparkSession = batch.sparkSession
        rows = batch.select(*schema.names)
        keyed = rows.withColumn("canon", digest(*schema.names))
        try:
            existing = spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            existing = None  # nothing has been written yet
        if existing is not None and existing.inputFiles():
            known = _indexed(spark, path, schema.names, existing)
            if rows.count() <= BROADCAST_ROWS:
                hits = known.join(F.broadcast(keyed.select("canon").distinct()), "canon", "left_semi").distinct()
                keyed = keyed.join(F.broadcast(hits), "canon", "left_anti")
            else:
                keyed = keyed.join(known, "canon", "left_anti")
        keyed.dropDuplicates(["canon"]).select(*schema.names).write.mode("append").parquet(path)

    return write


def balanced_stream(rows: DataFrame, scope: str, order: str, threshold: int = 10, carry: list[str] | None = None) -> DataFrame:
    """scope, order, the columns to carry, assigned of a stream with score_<type>, draw and flip columns. The state is the
    counts of a scope; rows of a micro-batch are folded in `order`, so any cut into batches that keeps the order gives the
    batch result."""
    kept = [scope, order, *(carry or [])]

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        balance = Balance(dict(zip(L.CATEGORIES, state.get, strict=True)) if state.exists else None, threshold)
        pdf = pd.concat(list(frames)).sort_values(order, kind="stable")
        out = [balance.assign({t: getattr(r, f"score_{t}") for t in L.TYPES}, int(r.draw), int(r.flip)) for r in pdf.itertuples(index=False)]
        state.update(tuple(balance.counts[c] for c in L.CATEGORIES))
        yield pdf[kept].assign(**{scope: key[0], "assigned": out})

    kinds = dict(rows.dtypes)
    counts = ", ".join(f"{c} long" for c in L.CATEGORIES)
    schema = ", ".join(f"{c} {kinds[c]}" for c in kept)
    return rows.groupBy(F.col(scope)).applyInPandasWithState(fold, f"{schema}, assigned string", counts, "append", GroupStateTimeout.NoTimeout)
