"""Sinks: idempotent appends, manifests, chunks, nested books, reports. Spark's commit protocol stands in for locks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.lexicons import FILE_PREFIX
from ..session import shared_folder


def canonical(*columns: str) -> Column:
    """A record as JSON with its fields in alphabetical order: equal records have equal text."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]))


def digest(*columns: str) -> Column:
    """32 bytes (SHA-256) that stand for a record: equal records, and no others, have equal ones."""
    return F.unhex(F.sha2(canonical(*columns), 256))


def new_rows(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Distinct incoming records that are not among the existing; appending them twice is appending them once. Records are
    held together by their digests, so existing ones go through no shuffle as they are."""
    columns = incoming.columns
    fresh = incoming.withColumn("canon", digest(*columns)).dropDuplicates(["canon"])
    known = existing.select(digest(*columns).alias("canon")).distinct()
    return fresh.join(known, "canon", "left_anti").select(*columns)


def dedup_append(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    return existing.unionByName(new_rows(incoming, existing))


def manifest_rows(types_and_isbns: DataFrame) -> DataFrame:
    """file_name, type, isbn for (type, isbn); the manifest's type is the lowered first part of the file name."""
    prefix = F.create_map(*[F.lit(x) for kv in FILE_PREFIX.items() for x in kv])
    name = F.concat(prefix[F.col("type")], F.lit("_QA-"), F.col("isbn"), F.lit(".json"))
    return types_and_isbns.select(name.alias("file_name"), F.lower(F.split_part(name, F.lit("_"), F.lit(1))).alias("type"), F.col("isbn").cast("string").alias("isbn"))


def manifest_upsert(existing: DataFrame, rows: DataFrame) -> DataFrame:
    return existing.unionByName(rows).dropDuplicates(["file_name", "type", "isbn"])


def chunked(rows: DataFrame, order: list[str], size: int = 50, name: str = "mc_chunk") -> DataFrame:
    """rows with chunk: name_001 for the first `size` rows in order, and so on.

    A global row number would put all rows in one task. Rows are written once in ranges, sorted; the files' ranges are
    then numbered apart, and offset by the counts of the ranges before, which are as few as the tasks that wrote."""
    spark, folder = rows.sparkSession, shared_folder(rows.sparkSession, "ranges")
    kept = [F.col(c).alias(f"c{i}") for i, c in enumerate(rows.columns)]
    keys = [f"c{rows.columns.index(c)}" for c in order]
    ranged = rows.select(*kept).repartitionByRange(*keys).withColumn("part", F.spark_partition_id())
    ranged.write.parquet(folder)
    parts = spark.read.schema(ranged.schema).parquet(folder)
    before = parts.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(*keys))
    # One row a range.
    numbered = parts.withColumn("own", own).join(F.broadcast(before), "part")
    number = F.floor((F.col("own") + F.col("before") - 1) / size).cast("long") + 1
    return numbered.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rows.columns)], F.format_string(f"{name}_%03d", number).alias("chunk"))


def nested_books(paragraphs: DataFrame) -> DataFrame:
    """isbn, title, paragraphs in order of position: the document of a book file."""
    item = F.struct("position", F.col("paragraph_id").alias("Paragraph ID"), F.col("section").alias("Section"), F.col("page").alias("Page"), F.col("text").alias("Text"))
    books = paragraphs.groupBy("isbn", "title").agg(F.array_sort(F.collect_list(item)).alias("p"))
    return books.select("isbn", "title", F.transform("p", lambda x: x.dropFields("position")).alias("paragraphs"))


def write_books(books: DataFrame, folder: str) -> None:
    """books (isbn, title, paragraphs) as JSON, a folder `file=<isbn>_processed` a book."""
    named = books.select(F.concat("isbn", F.lit("_processed")).alias("file"), F.col("isbn").alias("ISBN"), F.col("title").alias("Title"), F.col("paragraphs").alias("Paragraphs"))
    named.write.mode("overwrite").partitionBy("file").json(folder)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to a place that isn't taken yet; this is how a result becomes visible as a whole."""
    context = spark.sparkContext
    a, b = (context._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    files = a.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(b.getParent())
    if files.exists(b) or not files.rename(a, b):
        raise OSError(f"{source} could not be moved to {target}")


def write_catalog(rows: DataFrame, path: str) -> None:
    """A catalog or manifest as CSV with a header, in as many files as there are tasks."""
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_catalogs_by(rows: DataFrame, column: str, folder: str) -> None:
    """A catalog for each value of a column."""
    rows.write.mode("overwrite").option("header", True).partitionBy(column).csv(folder)


def write_stages(outputs: dict[str, DataFrame], folder: str) -> None:
    """The outputs of several stages, which share one plan, each in its own folder, by one write."""
    rows = None
    for stage, df in outputs.items():
        part = df.withColumn("stage", F.lit(stage))
        rows = part if rows is None else rows.unionByName(part)
    rows.write.mode("overwrite").partitionBy("stage").json(folder)


def overwrite_questions(questions: DataFrame, path: str) -> None:
    """All that there is, in place of what there was; null fields are left out of the JSON."""
    questions.write.mode("overwrite").json(path)


def count_report(outputs: dict[str, DataFrame]) -> DataFrame:
    """output, records of the outputs that are there."""
    parts = [df.agg(F.count("*").alias("records")).select(F.lit(name).alias("output"), "records") for name, df in outputs.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
