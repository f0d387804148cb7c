"""Connected components as DataFrames: no link or label ever comes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of links (a, b); the component is its smallest node.

    Each round every node takes its smallest neighbour (or itself) as parent, parents are followed to their roots (each
    step doubles the way), and the links are contracted to roots; links within a root vanish. Every node that is left
    then stands for two at least, so rounds and steps grow with the logarithm of the nodes. Each is written to the
    shared folder.
    """
    scratch = Scratch()
    links = scratch.cut(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = scratch.cut(both.groupBy("a").agg(F.least("a", F.min("b")).alias("b"), F.lit(True).alias("moved")))
        while True:
            step = parents.select(F.col("a").alias("__of"), F.col("b").alias("__to"))
            moved = scratch.cut(parents.join(step, F.col("b") == F.col("__of")).select("a", F.col("__to").alias("b"), (F.col("__to") != F.col("b")).alias("moved")))
            scratch.drop(parents)
            parents = moved
            if moved.where("moved").isEmpty():
                break
        to = parents.select("a", "b")
        labelled = scratch.cut(to if labels is None else _through(labels, to, "b").unionByName(_new(to, labels)))
        left = _through(_through(links, to, "a"), to, "b").where("a <> b")
        left = scratch.cut(left.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        scratch.drop(parents, links, *([] if labels is None else [labels]))
        labels, links = labelled, left
    return (links if labels is None else labels).select(F.col("a").alias("node"), F.col("b").alias("component"))


def _through(rows: DataFrame, parents: DataFrame, column: str) -> DataFrame:
    """rows with `column` replaced by its parent where it has one."""
    step = parents.select(F.col("a").alias("__of"), F.col("b").alias("__parent"))
    return rows.join(step, F.col(column) == F.col("__of"), "left").withColumn(column, F.coalesce("__parent", column)).select("a", "b")


def _new(parents: DataFrame, labels: DataFrame) -> DataFrame:
    return parents.join(labels.select("a"), "a", "left_anti").select("a", "b")
