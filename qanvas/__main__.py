"""Command line: run a registered query, or the generation flow over book files.

    python -m qanvas query NAME --tables DIR --out DIR
    python -m qanvas generate --books DIR --prompts DIR --out DIR [--start N] [--max-entries N] [--threshold N] [--generator MODULE:FUNCTION]
"""

from __future__ import annotations

import argparse
import importlib
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import generation as G
from .plans.registry import QUERIES
from .session import session
from .sources import books as B
from .sources import sinks as S


@dataclass(frozen=True)
class GenerateConfig:
    """What the generation flow is run with. Paragraphs of a book from `start` on and before `max_entries` take part."""

    books: str
    prompts: str
    out: str
    start: int = 0
    max_entries: int | None = None
    threshold: int = 10
    #: module:function that adds completion to rows (type, prompt, ...).
    generator: str = ""

    def __post_init__(self) -> None:
        if self.start < 0 or self.threshold < 1 or self.max_entries is not None and self.max_entries < 0:
            raise ValueError("start and max_entries must not be negative, threshold must be positive")


def generator_of(name: str) -> G.Generate:
    module, _, function = name.partition(":")
    if not function:
        raise ValueError("a generator is named module:function")
    return getattr(importlib.import_module(module), function)


def generate(spark: SparkSession, config: GenerateConfig) -> DataFrame:
    """Questions of all books, appended to what `out` has, a folder a type and book; returns the manifest's new rows."""
    paragraphs = B.book_paragraphs(B.books(spark, f"{config.books.rstrip('/')}/*_processed*"))
    inside = F.col("position") >= config.start
    if config.max_entries is not None:
        inside &= F.col("position") < config.max_entries
    found = G.generated(paragraphs.where(inside), B.templates(spark, config.prompts), generator_of(config.generator), threshold=config.threshold)
    path = f"{config.out.rstrip('/')}/questions"
    known = spark.read.schema(G.SAVED).parquet(path) if B.exists(spark, path) else spark.createDataFrame([], G.SAVED)
    S.new_rows(found, known.select(*found.columns)).write.mode("append").partitionBy("type", "isbn").parquet(path)
    manifest = f"{config.out.rstrip('/')}/manifest"
    new = S.new_rows(S.manifest_rows(spark.read.schema(G.SAVED).parquet(path).select("type", "isbn").distinct()), B.manifest(spark, manifest))
    rows = new.collect()  # a row a new file
    if rows:
        spark.createDataFrame(rows, new.schema).write.mode("append").option("header", True).csv(manifest)
    return spark.createDataFrame(rows, new.schema)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="qanvas")
    commands = out.add_subparsers(dest="command", required=True)
    q = commands.add_parser("query", help="run a registered query over a folder of tables")
    q.add_argument("name", choices=sorted(QUERIES))
    q.add_argument("--tables", required=True)
    q.add_argument("--out", required=True)
    g = commands.add_parser("generate", help="gate, type, ask, parse and save questions of book files")
    for f in fields(GenerateConfig):
        kind = int if f.name in ("start", "max_entries", "threshold") else str
        needed = f.name in ("books", "prompts", "out", "generator")
        g.add_argument(f"--{f.name.replace('_', '-')}", type=kind, required=needed, **({} if needed else {"default": f.default}))
    return out


def main(arguments: list[str] | None = None) -> None:
    given = vars(parser().parse_args(arguments))
    command = given.pop("command")
    if command == "query":
        QUERIES[given["name"]](session(), given["tables"]).write.mode("errorifexists").parquet(given["out"])
    else:
        generate(session(), GenerateConfig(**given))


if __name__ == "__main__":
    main()
