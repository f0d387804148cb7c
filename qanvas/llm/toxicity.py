"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Index: the labelled rows outside the held-out fold, at most `max_examples` of them, those of smallest hash (the
documented bound of the sample). Terms are all words of `common.ALNUM` in min_df distinct examples or more. A text is its
TF-IDF vector over them, of length 1, with weights (1 + ln tf) * (1 + ln((1 + n) / (1 + df))) * sqrt(1 + G): the last
factor is the term's relevance, G its likelihood-ratio statistic with the label over distinct examples. It is about 1 for
a word that says nothing of the label, so such words weigh as in plain TF-IDF; without it, the cosine is ruled by what
texts are about (at sf0.1, held-out accuracy 0.94 instead of 0.99).

Search: postings hold the examples in blocks of `block`; for every term and block the largest weight is kept. A query
sums its terms' block maxima to a bound for each block, takes blocks in falling order of bounds, in rounds of growing
size, scores their examples exactly, and stops when the k-th best cosine is above the next bound, so the neighbours are
exact. Postings of terms in a twentieth of the examples or more are kept as dense rows, multiplied for many texts at once;
a block's bound then has their exact sum for its best example and the maxima of the other terms. Examples are dealt to blocks by their words in common and by length, which keeps a block's maxima near its members.

Score: votes weighted by nearness (the cosine, 1 less the distance), with the share of toxic among the examples as the vote of weight `prior_weight`, then
calibrated by a logistic curve that is fitted to leave-one-out votes of the examples. The neighbours are the
evidence.

The index is bounded by max_examples and is broadcast; every text is scored whole, in one pass without a shuffle.

Defined cases: null text is empty; repeated ids with labels that differ count by their mean (ties are 1); null labels
and ids teach nothing; without labels every score is 0; ties of cosine go to the example that comes first by its hash;
extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, lots, map_arrow, remainder, sigmoid, text_bytes
from .quality import labelled

EVIDENCE = "array<struct<doc_id:bigint,cosine:double,toxic:int>>"


def words(data: bytes) -> list[bytes]:
    return data.translate(ALNUM).split()


def likelihood_ratio(a: np.ndarray, df: np.ndarray, positive: int, n: int) -> np.ndarray:
    """G statistic of term presence (a positive of df) against the label (positive of n)."""

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)

    b, c, d = df - a, positive - a, n - positive - df + a
    return np.maximum(0, 2 * (part(a, df * positive / n) + part(b, df * (n - positive) / n) + part(c, (n - df) * positive / n) + part(d, (n - df) * (n - positive) / n)))


class Index:
    """The block-max inverted index of labelled examples."""

    def __init__(self, ids: list[int], texts: list[bytes], y: list[int], k: int = 15, block: int = 64, min_df: int = 2, prior_weight: float = 0.5, dense_share: float = 0.05) -> None:
        self.k, self.block, self.prior_weight = k, block, prior_weight
        n = len(y)
        self.prior = (sum(y) + 0.5) / (n + 1)
        # Copies would make any of their words look telling: statistics are over distinct texts.
        distinct = dict(zip(texts, range(n), strict=True))
        df: Counter = Counter()
        toxic: Counter = Counter()
        for i in distinct.values():
            own = set(words(texts[i]))
            df.update(own)
            if y[i]:
                toxic.update(own)
        terms = sorted(t for t, f in df.items() if f >= min_df)
        self.number = {t: i for i, t in enumerate(terms)}
        f, a = np.array([df[t] for t in terms], dtype=np.float64), np.array([toxic[t] for t in terms], dtype=np.float64)
        positive = sum(y[i] for i in distinct.values())
        self.idf = (1 + np.log((1 + len(distinct)) / (1 + f))) * np.sqrt(1 + likelihood_ratio(a, f, positive, len(distinct)))

        del df, toxic
        vectors = [self.weigh(Counter(words(t))) for t in texts]
        order = self._order(vectors, f)
        self.ids, self.y, self.place = np.array(ids, dtype=np.int64)[order], np.array(y, dtype=np.float64)[order], order
        vectors = [vectors[i] for i in order]
        term = np.concatenate([np.empty(0, np.int64), *(v[0] for v in vectors)])
        weight = np.concatenate([np.empty(0), *(v[1] for v in vectors)])
        example = np.repeat(np.arange(n, dtype=np.int32), [len(v[0]) for v in vectors])
        spread = np.bincount(term, minlength=len(terms))
        # Dense rows of the terms with most postings, and which row a term has.
        often = np.flatnonzero(spread >= max(2, dense_share * n))
        self.row = np.full(len(terms), -1)
        self.row[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), n))
        is_dense = self.row[term] >= 0
        self.dense[self.row[term[is_dense]], example[is_dense]] = weight[is_dense]
        term, weight, example = term[~is_dense], weight[~is_dense], example[~is_dense]
        by = np.lexsort((example, term))
        term, self.example, self.weight = term[by], example[by], weight[by]
        self.n_blocks = -(-n // block)
        self.edges = np.arange(0, n, block)
        group = term * (self.n_blocks + 1) + self.example // block
        # Runs: the postings of a term in a block. Where each starts and ends, its block and its largest weight.
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        self.run_start, self.run_end = starts, np.append(starts[1:], len(group))
        self.run_block, self.run_max = self.example[starts] // block, np.maximum.reduceat(self.weight, starts) if len(starts) else np.empty(0)
        self.run_first = np.searchsorted(term[starts], np.arange(len(terms) + 1))
        self.slope, self.shift, self.scored = 1.0, 0.0, 0
        votes = np.array([self.vote(*found) for found in self.search(vectors, leave_out=True)])
        self.slope, self.shift = calibrate(votes, self.y)

    def _order(self, vectors: list[tuple[np.ndarray, np.ndarray]], df: np.ndarray) -> np.ndarray:
        """Examples by their heaviest term of many examples, then by their number of terms."""
        common = df >= max(2, 0.02 * len(vectors))
        top = [int(t[np.argmax(np.where(common[t], w, -1))]) if len(t) else -1 for t, w in vectors]
        return np.lexsort((np.arange(len(vectors)), [len(t) for t, _ in vectors], top))

    def weigh(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and the weights of a vector of length 1."""
        get = self.number.get
        found = [(i, c) for w, c in counts.items() if (i := get(w)) is not None]
        if not found:
            return np.empty(0, np.int64), np.empty(0)
        found.sort()
        t, c = np.array(found, dtype=np.int64).T
        w = (1 + np.log(c)) * self.idf[t]
        return t, w / np.sqrt((w**2).sum())

    def search(self, vectors: list[tuple[np.ndarray, np.ndarray]], leave_out: bool = False, lot: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For every vector the places of the k nearest examples with a positive cosine, and their cosines, exactly. With
        leave_out, the vectors are those of the examples, and each is left out of its own answer."""
        for at in range(0, len(vectors), lot):
            part = vectors[at : at + lot]
            frequent = np.zeros((len(part), len(self.dense)))
            for i, (t, w) in enumerate(part):
                own = self.row[t]
                frequent[i, own[own >= 0]] = w[own >= 0]
            sums = frequent @ self.dense
            for i, (t, w) in enumerate(part):
                rare = self.row[t] < 0
                yield self._nearest(t[rare], w[rare], sums[i], at + i if leave_out else -1)

    def _nearest(self, terms: np.ndarray, weights: np.ndarray, scores: np.ndarray, skip: int) -> tuple[np.ndarray, np.ndarray]:
        """The answer from the rare terms and the sums that the frequent ones give every example."""
        if skip >= 0:
            scores[skip] = -1
        run, run_weight = _ranges(self.run_first[terms], self.run_first[terms + 1], weights)
        at_block = self.run_block[run]
        bound = np.maximum.reduceat(scores, self.edges) + np.bincount(at_block, weights=run_weight * self.run_max[run], minlength=self.n_blocks)
        order = np.argsort(-bound, kind="stable")
        found, cosines, at, size = np.empty(0, np.int64), np.empty(0), 0, 8
        while at < self.n_blocks and bound[order[at]] > 0 and not (len(found) == self.k and cosines[-1] >= bound[order[at]] + 1e-9):
            taken = order[at : at + size]
            near = (taken[:, None] * self.block + np.arange(self.block)).ravel()
            near = near[near < len(self.y)]
            total = scores.copy()
            chosen = np.zeros(self.n_blocks, dtype=bool)
            chosen[taken] = True
            mine = chosen[at_block]
            posting, posting_weight = _ranges(self.run_start[run[mine]], self.run_end[run[mine]], run_weight[mine])
            np.add.at(total, self.example[posting], posting_weight * self.weight[posting])
            floor = cosines[-1] - 1e-9 if len(found) == self.k else 0
            hit = near[total[near] > floor]
            if len(hit) > 4 * self.k:  # no more than can be among the best
                hit = hit[total[hit] >= np.partition(total[hit], -self.k)[-self.k] - 1e-9]
            found, cosines = np.concatenate([found, hit]), np.concatenate([cosines, total[hit]])
            best = np.lexsort((self.place[found], -np.round(cosines, 12)))[: self.k]
            found, cosines = found[best], cosines[best]
            at, size = at + size, size * 4
        self.scored += min(at, self.n_blocks)
        return found, cosines

    def search_texts(self, texts: Iterable[bytes], lot: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """search for texts as they come, `lot` at a time."""
        texts = iter(texts)
        while part := list(islice(texts, lot)):
            yield from self.search([self.weigh(Counter(words(t))) for t in part])

    def vote(self, found: np.ndarray, cosines: np.ndarray) -> float:
        total = cosines.sum() + self.prior_weight
        return float(((cosines * self.y[found]).sum() + self.prior_weight * self.prior) / total)

    def score(self, votes: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * log_odds(votes) + self.shift)


def _ranges(starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, one after another, and the value of each one's range."""
    n = ends - starts
    shift = starts - (np.cumsum(n) - n)
    return np.repeat(shift, n) + np.arange(n.sum()), np.repeat(values, n)


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def calibrate(votes: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope (kept positive) and shift of a logistic curve over the votes' log odds, by Newton's method with a weak prior."""
    x, a, b = log_odds(votes), 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * x + b)
        g = np.array([((p - y) * x).sum() + (a - 1), (p - y).sum() + b * 0.01])
        r = p * (1 - p)
        h = np.array([[(r * x * x).sum() + 1, (r * x).sum()], [(r * x).sum(), r.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        a, b = max(0.05, a - step[0]), b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = 6_000, block: int = 64) -> Index | None:
    sample = labelled(labels, "toxic", (5, 0), max_examples)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "y").dropDuplicates()

    def per_task(batches):
        for batch in batches:  # only word counts matter, so short texts travel
            yield {"doc_id": batch.column("doc_id"), "y": batch.column("y"), "text": [b" ".join(sorted(words(t))) for t in text_bytes(batch.column("text"))]}

    got = map_arrow(rows, ["doc_id", "text", "y"], per_task, "doc_id bigint, y int, text binary").collect()
    if not got:
        return None
    got.sort(key=lambda r: (r["doc_id"], bytes(r["text"])))
    return Index([r["doc_id"] for r in got], [bytes(r["text"]) for r in got], [r["y"] for r in got], block=block)


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_examples: int = 6_000, evidence: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (the nearest examples)."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, max_examples))

    def per_task(batches):
        index = shared.value
        for batch in batches:
            votes, shown = np.zeros(batch.num_rows), []
            texts = (text for lot in lots(batch, 1_000_000) for text in text_bytes(lot.column("text"))) if index else ()
            for i, (found, cosines) in enumerate(index.search_texts(texts) if index else ()):
                votes[i] = index.vote(found, cosines)
                shown.append([{"doc_id": int(index.ids[e]), "cosine": float(c), "toxic": int(index.y[e])} for e, c in zip(found[:evidence], cosines[:evidence], strict=True)])
            scores = index.score(votes) if index else votes
            yield {"doc_id": batch.column("doc_id"), "score": scores, "predicted": (scores >= threshold).astype(np.int32), "evidence": shown or [[]] * batch.num_rows}

    scored = map_arrow(docs, ["doc_id", "text"], per_task, f"doc_id bigint, score double, predicted int, evidence {EVIDENCE}")
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "evidence")
