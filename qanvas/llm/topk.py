"""Exact top-k inner-product search by pivot-table elimination.

Every vector is quantised to integers floor(scale * x). Pivots (the origin, and centres of a bounded sample: k-means from
rows far apart) are compared once with every vector: that is the pivot table. For a query q and a candidate c the triangle
inequality gives d(q, c) >= max over pivots |d(q, p) - d(c, p)|, so the inner product (|q|^2 + |c|^2 - d^2) / 2 is at
most a bound. Candidates of a batch lie in groups round their nearest pivot, with the least and largest distance of a group to every pivot. A query
takes the groups in falling order of their bound, in rounds of growing size, rules out candidates of a round by their own
bounds, evaluates the others, and stops when the k-th best score exceeds the next bound. A query's k best are carried from batch to batch of a task,
so later batches start with a high threshold.

Plan: the queries are a stated set; they are taken in blocks of `query_block` rows, so what is broadcast is bounded
whatever the table. A block goes over the table once: each task returns the k best of its candidates per query, and a
grouped merge of those (k rows per query and task) gives the ranks. Blocks after the first are written to the shared
folder one after another.

Defined cases: vectors null or holding null or non-finite components take no part; a query has no other candidates than
vectors of its own length; rows repeating the query's vec_id are its own and no candidates; a repeated query id is
answered for its smallest vector; null ids take no part; ties go to the smaller vec_id; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, map_arrow

SCHEMA = "query_id bigint, vec_id bigint, score bigint"
RESULT = ["query_id", "rank", "vec_id", "score"]
#: Above it products are summed as Python integers: doubles are exact below 2^53.
EXACT = float(1 << 52)


def quantised(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id, and v: the vector as whole numbers in doubles; rows that take no part are gone."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & v.isNotNull() & fine).select(
        "vec_id", F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("double")).alias("v")
    )


def choose_pivots(vectors: DataFrame, count: int = 64, sample: int = 4096, rounds: int = 6) -> dict[int, np.ndarray]:
    """By vector length: the origin, and centres of a bounded sample by hash, from farthest-first rows by k-means."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(len(r["v"]), []).append(r["v"])
    return {length: centres(np.array(vs, dtype=np.float64).reshape(len(vs), length), count, rounds) for length, vs in by.items()}


def centres(x: np.ndarray, count: int, rounds: int) -> np.ndarray:
    near = np.full(len(x), np.inf)
    at, chosen = int(np.argmax((x**2).sum(1))), []
    for _ in range(min(count - 1, len(x))):
        chosen.append(x[at])
        near = np.minimum(near, ((x - x[at]) ** 2).sum(1))
        at = int(np.argmax(near))
    c = np.array(chosen).reshape(len(chosen), x.shape[1])
    for _ in range(rounds if len(c) else 0):
        own = pivot_distances(x, c).argmin(axis=1)
        n = np.bincount(own, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return np.concatenate([np.zeros((1, x.shape[1])), c])


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def inner(x: np.ndarray, q: np.ndarray, largest: float | None = None) -> np.ndarray:
    """Exact inner products of the rows of x, of components up to `largest`, with q."""
    if len(x) and (float(np.abs(x).max(initial=0)) if largest is None else largest) * float(np.abs(q).max(initial=0)) * max(1, len(q)) < EXACT:
        return (x @ q).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(row, q, strict=True)) for row in x]
    return np.array([max(-(1 << 63), min((1 << 63) - 1, s)) for s in exact], dtype=np.int64)


class Table:
    """The pivot table of a batch: candidates in groups round their nearest pivot."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, group: int = 64) -> None:
        distances = pivot_distances(x, pivots)
        order = np.lexsort((distances.min(axis=1), distances.argmin(axis=1)))
        self.ids, self.x, self.distances, self.square = ids[order], x[order], distances[order], (x[order] ** 2).sum(1)
        cell = self.distances.argmin(axis=1)
        edges = np.concatenate([np.arange(a, b, group) for a, b in _cells(cell)]) if len(x) else np.empty(0, np.int64)
        self.edges = np.append(edges, len(x))
        self.size = float(np.abs(x).max(initial=0))
        self.asked = self.bounded = self.excluded = 0
        if len(x):
            self.low, self.high = np.minimum.reduceat(self.distances, edges), np.maximum.reduceat(self.distances, edges)
            self.largest = np.maximum.reduceat(self.square, edges)

    def _bound(self, square, q_square: float, low) -> np.ndarray:
        # Rounding of the bound is covered by a slack that is far below 1 for 52-bit products, and grows with them.
        return (square + q_square - low**2) / 2 + 0.5 + 1e-9 * (square + q_square)

    def best(self, q_id: int, q: np.ndarray, q_distances: np.ndarray, q_square: float, k: int, kept_ids=None, kept=None) -> tuple[np.ndarray, np.ndarray, int]:
        """The k best (score, then id) of these candidates and those kept before, and how many were evaluated."""
        kept_ids, kept = (np.empty(0, np.int64), np.empty(0, np.int64)) if kept is None else (kept_ids, kept)
        if not len(self.x):
            return kept_ids, kept, 0
        apart = np.maximum(np.maximum(self.low - q_distances, q_distances - self.high).max(axis=1), 0)
        by_group = self._bound(self.largest, q_square, apart)
        groups, at, seen, size = np.argsort(-by_group, kind="stable"), 0, 0, 4
        # Candidates' own bounds cost more than products, so they are taken where they have paid of late, and tried now and then.
        self.asked += 1
        own_bounds = self.asked <= 4 or self.asked % 16 == 0 or self.excluded > 0.3 * self.bounded
        while at < len(groups) and not (len(kept) == k and kept[-1] > by_group[groups[at]]):
            mine = groups[at : at + size]
            if len(kept) == k:
                mine = mine[by_group[mine] >= kept[-1]]
            rows = _spread(self.edges[mine], self.edges[mine + 1])
            if own_bounds and len(kept) == k:
                fine = self._bound(self.square[rows], q_square, np.abs(self.distances[rows] - q_distances).max(axis=1)) >= kept[-1]
                self.bounded, self.excluded = self.bounded + len(rows), self.excluded + len(rows) - int(fine.sum())
                rows = rows[fine]
            rows = rows[self.ids[rows] != q_id]
            scores = inner(self.x, q, self.size)[rows] if 2 * len(rows) > len(self.x) else inner(self.x[rows], q, self.size)
            seen += len(rows)
            if len(kept) == k:
                good = scores >= kept[-1]
                rows, scores = rows[good], scores[good]
            if len(scores) > 4 * k:  # no more than can be among the best
                good = scores >= np.partition(scores, -k)[-k]
                rows, scores = rows[good], scores[good]
            kept_ids, kept = np.concatenate([kept_ids, self.ids[rows]]), np.concatenate([kept, scores])
            top = np.lexsort((kept_ids, -kept))[:k]
            kept_ids, kept = kept_ids[top], kept[top]
            at, size = at + size, size * 4
        return kept_ids, kept, seen


def _spread(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after another."""
    n = ends - starts
    return np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _cells(cell: np.ndarray) -> list[tuple[int, int]]:
    """Where each run of equal values starts and ends."""
    starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    return list(zip(starts.tolist(), [*starts[1:].tolist(), len(cell)], strict=True))


def _matrix(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) by vector length of an Arrow list column."""
    lengths = np.asarray(column.value_lengths())
    flat, offsets = np.asarray(column.flatten(), dtype=np.float64), np.concatenate([[0], np.cumsum(lengths)])
    out = []
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        out.append((rows, flat[offsets[rows][:, None] + np.arange(n)].reshape(len(rows), n)))
    return out


def _search_block(table: DataFrame, queries: list, pivots: dict[int, np.ndarray], k: int) -> DataFrame:
    by: dict[int, list] = {}
    for r in queries:
        by.setdefault(len(r["v"]), []).append(r)
    packed = {}
    for n, rows in by.items():
        x, p = np.array([r["v"] for r in rows], dtype=np.float64).reshape(len(rows), n), pivots.get(n, np.zeros((1, n)))
        packed[n] = (np.array([r["vec_id"] for r in rows], dtype=np.int64), x, pivot_distances(x, p), (x**2).sum(1), p)
    shared = table.sparkSession.sparkContext.broadcast(packed)

    def per_task(batches):
        kept: dict[int, list] = {n: [(None, None)] * len(q[0]) for n, q in shared.value.items()}
        for batch in batches:
            all_ids = np.asarray(batch.column("vec_id"))
            for rows, x in _matrix(batch.column("v")):
                if x.shape[1] not in shared.value:
                    continue
                q_ids, q, q_distances, q_square, p = shared.value[x.shape[1]]
                found, table = kept[x.shape[1]], Table(all_ids[rows], x, p)
                for i in range(len(q_ids)):
                    found[i] = table.best(q_ids[i], q[i], q_distances[i], q_square[i], k, *found[i])[:2]
        for n, found in kept.items():
            some = [(q, i, s) for q, (i, s) in zip(shared.value[n][0].tolist(), found, strict=True) if i is not None]
            yield {"query_id": np.repeat([q for q, _, _ in some], [len(i) for _, i, _ in some]).astype(np.int64), "vec_id": np.concatenate([np.empty(0, np.int64), *(i for _, i, _ in some)]), "score": np.concatenate([np.empty(0, np.int64), *(s for _, _, s in some)])}

    return ranked(map_arrow(table, ["vec_id", "v"], per_task, SCHEMA), k)


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(*RESULT)


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: int = 1024, pivots: int = 64, query_block: int = 16_384) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for every row that is_query holds for."""
    table = quantised(vectors, scale)
    chosen = choose_pivots(table, pivots)
    queries = table.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = -(-queries.count() // query_block)
    if not blocks:
        return table.limit(0).select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score"))
    done = None
    for b in range(blocks):
        mine = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b)
        part = _search_block(table, mine.collect(), chosen, k)
        if blocks > 1:
            part = cut(part)
        done = part if done is None else done.unionByName(part)
    return done
