"""The corpus pipeline: quality, near duplicates, decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on all that the one before it kept, and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from qanvas.llm import decontaminate, near_dedup, packing, quality, secrets
from qanvas.llm.common import delete, fresh_path, tables_dropped


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document of smallest id stays."""
    return near_dedup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Credentials are replaced in the texts; documents stay."""
    return secrets.redact(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a training sequence."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("packing", packed_sequences),
]

#: The models of the first and fourth stage are trained, so SQL can't express the rows; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written to the shared folder and read again. Once a stage is
    written, what it has read and the tables that it made on its way are dropped."""
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    folder = fresh_path(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{i}-{name}"
        with tables_dropped(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if read is not None:
            delete(spark, read)
        docs, read = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
