"""Scans: catalogs, documents, books, question files, lexicons, templates; tolerant where a file is bad or missing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATALOG = T.StructType([T.StructField(n, T.StringType()) for n in ("Title", "ISBN-10", "ISBN-13", "File Link")])
PARAGRAPH = T.StructType([T.StructField("Paragraph ID", T.StringType()), T.StructField("Section", T.StringType()), T.StructField("Page", T.IntegerType()), T.StructField("Text", T.StringType())])
BOOK = T.StructType([T.StructField("ISBN", T.StringType()), T.StructField("Title", T.StringType()), T.StructField("Paragraphs", T.ArrayType(PARAGRAPH))])
MANIFEST = T.StructType([T.StructField(n, T.StringType()) for n in ("file_name", "type", "isbn")])


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, by the file system that Spark reads it with."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def catalog(spark: SparkSession, path: str, processed: bool = False) -> DataFrame:
    """title, isbn10, isbn13, file_link (and json_file of a processed one), all strings; missing values get the catalog's
    defaults, a missing file is an empty catalog."""
    schema = T.StructType([*CATALOG.fields, T.StructField("JSON File", T.StringType())]) if processed else CATALOG
    raw = spark.read.schema(schema).option("header", True).csv(path) if exists(spark, path) else spark.createDataFrame([], schema)
    unknown = {"Title": "Unknown Title", "ISBN-10": "Unknown ISBN-10", "ISBN-13": "Unknown ISBN-13", "File Link": ""} | ({"JSON File": ""} if processed else {})
    names = {"Title": "title", "ISBN-10": "isbn10", "ISBN-13": "isbn13", "File Link": "file_link", "JSON File": "json_file"}
    return raw.select(*[F.coalesce(F.col(f"`{c}`"), F.lit(d)).alias(names[c]) for c, d in unknown.items()])


def books_of(catalog: DataFrame, books: DataFrame) -> DataFrame:
    """The books of a catalog (isbn13); rows without a book, and books without a row, go."""
    return books.join(catalog.select(F.col("isbn13").alias("isbn")).distinct(), "isbn", "left_semi")


def valid_rows(catalog: DataFrame, files: DataFrame) -> DataFrame:
    """Rows that name a file that is there (files: path)."""
    return catalog.where(F.col("file_link") != "").join(files.select(F.col("path").alias("file_link")), "file_link", "left_semi")


def pages_of_files(files: DataFrame, extract: Callable[[bytes], list[str]]) -> DataFrame:
    """path, page (from 1), text, error for each page with text of binary files (path, content). `extract` turns a file
    into page texts; a file that it fails on is one row with the error."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    rows += [(path, i, text, None) for i, text in enumerate(extract(bytes(content)), 1) if text and text.strip()]
                except Exception as e:  # noqa: BLE001  a bad file must not end the scan
                    rows.append((path, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["path", "page", "text", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, page int, text string, error string")


def text_pages(spark: SparkSession, path: str) -> DataFrame:
    """path, page (from 1), text, error of files whose pages a form feed parts, as extractors write them. Files are read in
    ranges and page by page, so memory does not grow with a file. Empty pages are counted and left out; a page with bytes
    that are no UTF-8 has the error and no text."""
    raw = spark.read.option("lineSep", "\f").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("place"), F.col("value").alias("text")
    )
    # Ranges of a file in order, rows of a range in order: what sorts are two numbers a page, the text only follows.
    paged = raw.withColumn("page", F.row_number().over(Window.partitionBy("path").orderBy("start", "place")))
    bad = ~F.is_valid_utf8("text")
    kept = paged.where(F.trim(F.translate("text", "\n\r\t", "   ")) != "")
    return kept.select("path", "page", F.when(~bad, F.col("text")).alias("text"), F.when(bad, "not UTF-8").alias("error"))


def books(spark: SparkSession, path: str) -> DataFrame:
    """isbn, title, paragraphs of book files; files that are not JSON give no row."""
    raw = spark.read.schema(T.StructType([*BOOK.fields, T.StructField("_corrupt", T.StringType())])).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").option("ignoreMissingFiles", True).json(path)
    own = F.regexp_extract(F.input_file_name(), r"(?:file=)?([^/=]+)_processed(?:\.json|/[^/]*)$", 1)
    return raw.where(F.col("_corrupt").isNull()).select(F.coalesce(F.col("ISBN"), F.nullif(own, F.lit(""))).alias("isbn"), F.col("Title").alias("title"), F.col("Paragraphs").alias("paragraphs"))


def book_paragraphs(book: DataFrame) -> DataFrame:
    p = book.select("isbn", "title", F.posexplode("paragraphs").alias("position", "p"))
    return p.select("isbn", "title", "position", F.col("p.`Paragraph ID`").alias("paragraph_id"), F.col("p.Section").alias("section"), F.col("p.Page").alias("page"), F.col("p.Text").alias("text"))


def word_list(spark: SparkSession, *paths: str) -> DataFrame:
    """word: the distinct white-space separated words of text files."""
    return spark.read.text(list(paths)).select(F.explode(F.split("value", r"\s+")).alias("word")).where("word <> ''").distinct()


def templates(spark: SparkSession, path: str) -> DataFrame:
    """name, template of the prompt files in a folder."""
    return spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.prompt$", 1).alias("name"), F.col("value").alias("template"))


def saved_questions(spark: SparkSession, path: str, schema: T.StructType, arrays: bool = False) -> DataFrame:
    """Rows of saved JSON, a record a line as the sinks write it, or an array a file; corrupt or missing files count as
    empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", arrays).option("mode", "DROPMALFORMED").option("ignoreMissingFiles", True).json(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest, ISBNs as text; a missing one is empty."""
    return spark.read.schema(MANIFEST).option("header", True).csv(path) if exists(spark, path) else spark.createDataFrame([], MANIFEST)
