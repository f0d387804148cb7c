"""Principal components of a table of vectors, in one pass over it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vector as V

_PART = "lot int, n long, sums array<double>, products array<double>"


def moments(rows: DataFrame, vector: str, lots: int = 32) -> tuple[int, np.ndarray, np.ndarray]:
    """Count, sum and sum of outer products of the vectors. A task makes one row of sums, tasks are added up in `lots`
    groups, and so many rows come to the driver. Null vectors, and such with null or non-finite components, are left out;
    vectors of different length are an error."""

    def by_task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        n, sums, products = 0, 0.0, 0.0
        for pdf in frames:
            x = [np.asarray(v, dtype=float) for v in pdf[vector] if v is not None]
            x = np.array([v for v in x if np.isfinite(v).all()])
            if len(x):
                n, sums, products = n + len(x), sums + x.sum(0), products + x.T @ x
        if n:
            yield pd.DataFrame({"lot": [TaskContext.get().partitionId() % lots], "n": [n], "sums": [sums], "products": [products.ravel()]})

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lot": pdf["lot"][:1], "n": [pdf["n"].sum()], "sums": [np.sum(pdf["sums"].tolist(), axis=0)], "products": [np.sum(pdf["products"].tolist(), axis=0)]})

    parts = rows.select(vector).mapInPandas(by_task, _PART).groupBy("lot").applyInPandas(added, _PART).collect()
    if not parts:
        return 0, np.zeros(0), np.zeros((0, 0))
    sums, products = (np.sum([r[c] for r in parts], axis=0) for c in ("sums", "products"))
    return sum(r["n"] for r in parts), sums, products.reshape(len(sums), len(sums))


def principal_axes(rows: DataFrame, vector: str, k: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, the k axes of largest variance, and the variances. An axis points to where its largest component (the first,
    if several tie) is positive. Fewer vectors than two, or components than k, give fewer axes."""
    n, sums, products = moments(rows, vector)
    if n < 2:
        return (sums / n if n else sums), np.zeros((0, len(sums))), np.zeros(0)
    mean = sums / n
    values, vectors = np.linalg.eigh((products - n * np.outer(mean, mean)) / (n - 1))
    order = np.argsort(-values, kind="stable")[:k]
    axes = vectors[:, order].T
    signs = np.array([np.sign(a[np.argmax(np.round(np.abs(a), 9))]) or 1.0 for a in axes])
    return mean, axes * signs[:, None], values[order]


def projected(rows: DataFrame, vector: str, k: int = 2) -> DataFrame:
    """rows with pc1 to pck, the coordinates of their vector on the principal axes; null for vectors that were left out,
    and for axes that there aren't."""
    mean, axes, _ = principal_axes(rows, vector, k)
    x = V.doubles(vector)
    fits = F.size(x) == len(mean)
    for i in range(k):
        at = F.lit(None).cast("double")
        if i < len(axes):
            dot = V.dot(x, F.array(*map(F.lit, axes[i].tolist()))) - float(mean @ axes[i])
            at = F.when(fits & ~F.isnan(dot) & (F.abs(dot) < float("inf")), dot)
        rows = rows.withColumn(f"pc{i + 1}", at)
    return rows
