"""LM scoring: a log-bilinear model trained in numpy by noise-contrastive estimation, over all training documents.

Tokens: words after lowering A-Z, split at white space, then one end token a document (an empty byte string here).

Counts: every task counts its own tokens and emits its distinct ones in bounded lots; a grouped sum gives the count c of
every token, the total N and the number V of distinct tokens, over all training documents.

Model: the next token's class (the `classes` most frequent tokens, or one class for all others) has the score
(C1 r[w-1] + C2 r[w-2]) . q[w] + b[w]. Noise-contrastive estimation against the class unigram, with noise words shared
by a minibatch so that scores and gradients are matrix products, first trains a start model on about `seed_docs` documents
(in one task), then a replica of it in every task over all the training documents of that task; the replicas are
averaged, weighted by their tokens (grouped sums, so what is gathered is a model a task, and what comes to the driver
one model). With two context words there are classes^2 contexts:
log-normalisers of all of them come from batched matrix products once, and a token's normalised log-probability is a
dot product less a look-up. Tokens of the rest class are split by their counts, (c + 1) / (N_rest + V_rest + 1), which
leaves one share for tokens never seen; so the model is a distribution over all tokens.

Rare tokens: counts of the `head` most frequent tokens are broadcast (a fixed number); the other tokens of a document
join the counts by token, and their sums come back by row.

Defined cases: null text is empty and has the end token alone; null ids are scored, not learned from, not held out;
repeated rows are scored and learned from each time; with nothing to learn from every count is 0 and the model uniform;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_AZ, cut, map_arrow, remainder, text_bytes

END = b""


def tokens(data: bytes) -> list[bytes]:
    out = data.translate(LOWER_AZ).split()
    out.append(END)
    return out


class LogBilinear:
    """r, q: class vectors as context and as output; c: a matrix for each of the two positions; b: output biases.
    Classes 0..k-1 are tokens by falling count, k is the rest, k+1 (context only) stands before the text."""

    NAMES = ("r", "q", "c", "b")

    def __init__(self, unigram: np.ndarray, dim: int = 16, seed: int = 11) -> None:
        rng, n = np.random.default_rng(seed), len(unigram)
        self.unigram = unigram
        self.r = rng.normal(0, 0.1, (n + 1, dim)).astype(np.float32)
        self.q = rng.normal(0, 0.1, (n, dim)).astype(np.float32)
        self.c = np.stack([np.eye(dim), 0.5 * np.eye(dim)]).astype(np.float32)
        self.b = np.log(unigram).astype(np.float32)
        self.start_squares()

    def train(self, w: np.ndarray, w1: np.ndarray, w2: np.ndarray, rng, noise: int = 64, rate: float = 0.1) -> None:
        """One minibatch of next classes and their contexts."""
        n, k = len(w), len(self.unigram)
        drawn = np.searchsorted(self._cumulative(), rng.random(noise)).astype(np.int64)
        r1, r2 = self.r[w1], self.r[w2]
        h = r1 @ self.c[0].T + r2 @ self.c[1].T
        shift = np.log(noise * self.unigram).astype(np.float32)
        # d: gradients of the log-likelihood by the scores, of the true class and of the noise.
        d_true = 1 - _logistic((h * self.q[w]).sum(1) + self.b[w] - shift[w])
        d_noise = -_logistic(h @ self.q[drawn].T + self.b[drawn] - shift[drawn])
        dh = d_true[:, None] * self.q[w] + d_noise @ self.q[drawn]
        dq = _sum_rows(w, d_true[:, None] * h, k)
        np.add.at(dq, drawn, d_noise.T @ h)
        db = np.bincount(w, weights=d_true, minlength=k) + np.bincount(drawn, weights=d_noise.sum(0), minlength=k)
        dr = _sum_rows(w1, dh @ self.c[0], k + 1) + _sum_rows(w2, dh @ self.c[1], k + 1)
        dc = np.stack([dh.T @ r1, dh.T @ r2]) / n
        for name, grad in (("q", dq), ("b", db), ("r", dr), ("c", dc)):
            square = self.squares[name]
            square += grad**2
            getattr(self, name)[...] += (rate if name != "c" else rate / 10) * grad / np.sqrt(square)

    def start_squares(self, flat: np.ndarray | None = None) -> LogBilinear:
        """Adagrad's sums of squares, from the start or from a model that went on before."""
        self.squares, at = {}, 0
        for n in self.NAMES:
            x = getattr(self, n)
            self.squares[n] = np.full(x.shape, 1e-3, dtype=np.float32) if flat is None else flat[at : at + x.size].reshape(x.shape).astype(np.float32)
            at += x.size
        return self

    def _cumulative(self) -> np.ndarray:
        if "sums" not in self.__dict__:
            self.sums = np.cumsum(self.unigram / self.unigram.sum())
            self.sums[-1] = 1.0
        return self.sums

    def parameters(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES]).astype(np.float32)

    def load(self, flat: np.ndarray) -> LogBilinear:
        at = 0
        for n in self.NAMES:
            x = getattr(self, n)
            x[...] = flat[at : at + x.size].reshape(x.shape)
            at += x.size
        return self

    def normalise(self) -> LogBilinear:
        """Log-normalisers of all contexts, a batch of contexts at a time."""
        n = len(self.r)
        self.p1, self.p2 = self.r @ self.c[0].T, self.r @ self.c[1].T
        self.log_z = np.empty((n, n), dtype=np.float32)
        rest = self.p2 @ self.q.T + self.b
        for i in range(n):
            s = rest + self.p1[i] @ self.q.T
            top = s.max(1, keepdims=True)
            self.log_z[i] = top[:, 0] + np.log(np.exp(s - top).sum(1))
        return self

    def log_probabilities(self, w: np.ndarray, w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
        """Natural logarithms of the normalised class probabilities."""
        return ((self.p1[w1] + self.p2[w2]) * self.q[w]).sum(1) + self.b[w] - self.log_z[w1, w2]


def _logistic(x: np.ndarray) -> np.ndarray:
    return (1 / (1 + np.exp(-np.clip(x, -30, 30)))).astype(np.float32)


def _sum_rows(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(index, weights=rows[:, j], minlength=n) for j in range(rows.shape[1])], axis=1).astype(np.float32)


def contexts(classes: np.ndarray, ends: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two places before each, across documents laid end to end (ends: flags of last tokens)."""
    first = np.concatenate([[True], ends[:-1]]) if len(ends) else ends
    w1 = np.where(first, start, np.concatenate([[start], classes[:-1]]))
    second = np.concatenate([[False], first[:-1]]) if len(ends) else ends
    w2 = np.where(first | second, start, np.concatenate([[start, start], classes[:-2]])[: len(classes)])
    return w1, w2


def count_tokens(docs: DataFrame, lot: int = 500_000) -> DataFrame:
    """token, c over the given documents."""

    def per_task(batches):
        counted: Counter = Counter()
        for batch in batches:
            for data in text_bytes(batch.column("text")):
                counted.update(tokens(data))
                if len(counted) > lot:
                    yield {"token": list(counted.keys()), "c": list(counted.values())}
                    counted = Counter()
        yield {"token": list(counted.keys()), "c": list(counted.values())}

    return map_arrow(docs, ["text"], per_task, "token binary, c bigint").groupBy("token").agg(F.sum("c").alias("c"))


class Vocabulary:
    """Counts of the most frequent tokens, by falling count, and the totals over all tokens."""

    def __init__(self, head: list[tuple[bytes, int]], total: int, distinct: int, classes: int) -> None:
        # The end token is always a class.
        head = sorted(head, key=lambda x: (x[0] != END, -x[1], x[0]))
        self.number = {t: i for i, (t, _) in enumerate(head)}
        self.number.setdefault(END, len(self.number))
        self.count = np.array([c for _, c in head] + [0] * (len(self.number) - len(head)), dtype=np.int64)
        self.total, self.distinct = total, distinct
        self.classes = min(classes, len(self.count))
        own = self.count[: self.classes]
        self.rest_total, self.rest_distinct = total - int(own.sum()), distinct - int((own > 0).sum())
        weights = np.append(own, self.rest_total) + 1.0
        self.unigram = weights / weights.sum()

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Place in the head, or -1."""
        get = self.number.get
        return np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))

    def class_of(self, numbers: np.ndarray) -> np.ndarray:
        return np.where((numbers < 0) | (numbers >= self.classes), self.classes, numbers)


def vocabulary(counts: DataFrame, classes: int, head: int) -> Vocabulary:
    """The head is all tokens above a count: the lowest edge of eighths of a power of two that leaves `head` at most.
    Counting by such bins takes no sort and brings a few hundred rows to the driver, whatever the corpus."""
    bins = counts.groupBy(F.floor(F.log2("c") * 8).cast("int").alias("bin")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    edge, room = 0, head
    for b in sorted(bins, key=lambda r: -r["bin"]):
        if b["v"] > room:
            edge = b["bin"] + 1
            break
        room -= b["v"]
    top = counts.where((F.floor(F.log2("c") * 8).cast("int") >= edge) | (F.col("token") == F.lit(bytearray(END)))).collect()
    return Vocabulary([(bytes(r["token"]), r["c"]) for r in top], sum(b["n"] for b in bins), sum(b["v"] for b in bins), classes)


def _lots(batches, known: Vocabulary, lot: int = 200_000):
    """Documents of a task, laid end to end in lots: rows of the batch, words, their places, end flags."""
    for batch in batches:
        texts, at = text_bytes(batch.column("text")), 0
        while at < len(texts):
            words, sizes, stop = [], [], at
            while stop < len(texts) and len(words) < lot:
                own = tokens(texts[stop])
                words += own
                sizes.append(len(own))
                stop += 1
            ends = np.zeros(len(words), dtype=bool)
            ends[np.cumsum(sizes) - 1] = True
            yield batch, at, sizes, words, known.numbers(words), ends
            at = stop


def _replicas(docs: DataFrame, known: Vocabulary, model: LogBilinear, minibatch: int, dim: int, seed: int) -> DataFrame:
    """A replica of the model from every task that has documents: part, tokens, sums (parameters times tokens), squares."""
    spark = docs.sparkSession
    squares = np.concatenate([model.squares[n].ravel() for n in model.NAMES])
    start, known_ = spark.sparkContext.broadcast((model.parameters(), squares)), spark.sparkContext.broadcast(known)

    def per_task(batches):
        known, rng, seen = known_.value, np.random.default_rng(seed), 0
        own = LogBilinear(known.unigram, dim).load(start.value[0]).start_squares(start.value[1])
        for _, _, _, _, numbers, ends in _lots(batches, known):
            w = known.class_of(numbers)
            w1, w2 = contexts(w, ends, known.classes + 1)
            order = rng.permutation(len(w))
            for at in range(0, len(w), minibatch):
                part = order[at : at + minibatch]
                own.train(w[part], w1[part], w2[part], rng)
            seen += len(w)
        if seen:
            flat = own.parameters().astype(np.float64) * seen
            squares = np.concatenate([own.squares[n].ravel() for n in own.NAMES]).astype(np.float64) * seen
            at = range(0, len(flat), 1024)
            yield {"part": list(at), "tokens": [seen] * len(at), "sums": [flat[i : i + 1024].tolist() for i in at], "squares": [squares[i : i + 1024].tolist() for i in at]}

    return map_arrow(docs, ["text"], per_task, "part int, tokens bigint, sums array<double>, squares array<double>")


def _averaged(replicas: DataFrame, model: LogBilinear) -> LogBilinear:
    each = replicas.select("part", "tokens", F.posexplode(F.arrays_zip("sums", "squares")).alias("i", "x"))
    added = each.groupBy("part", "i").agg((F.sum("x.sums") / F.sum("tokens")).alias("mean"), (F.sum("x.squares") / F.sum("tokens")).alias("square"))
    flat, squares = model.parameters(), np.concatenate([model.squares[n].ravel() for n in model.NAMES])
    for r in added.collect():
        flat[r["part"] + r["i"]], squares[r["part"] + r["i"]] = r["mean"], r["square"]
    return model.load(flat).start_squares(squares)


def train(docs: DataFrame, known: Vocabulary, minibatch: int = 1024, dim: int = 16, seed_docs: int = 2_000) -> LogBilinear:
    model = LogBilinear(known.unigram, dim)
    # Documents number about as many as end tokens were counted.
    every = max(1, int(known.count[known.number[END]]) // seed_docs)
    few = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("text").repartition(1)
    model = _averaged(_replicas(few, known, model, minibatch // 2, dim, 1), model)
    return _averaged(_replicas(docs, known, model, minibatch, dim, 2), model).normalise()


SCORED = (
    "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, n_unplaced bigint, base double, model double, "
    "rare array<struct<token:binary,times:bigint>>"
)


def _score(docs: DataFrame, known: Vocabulary, model: LogBilinear) -> DataFrame:
    """What each document's frequent tokens give, and its other tokens with their times."""
    spark = docs.sparkSession
    known_, model_ = spark.sparkContext.broadcast(known), spark.sparkContext.broadcast(model)

    def per_task(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 40
        known, model = known_.value, model_.value
        logs = np.log10(known.count + 1.0)
        for batch, at, sizes, words, numbers, ends in _lots(batches, known):
            doc = np.repeat(np.arange(len(sizes)), sizes)
            w = known.class_of(numbers)
            w1, w2 = contexts(w, ends, known.classes + 1)
            by_model = model.log_probabilities(w, w1, w2) / math.log(10)
            placed = numbers >= 0
            log_count = np.where(placed, logs[np.maximum(numbers, 0)], 0.0)
            n = len(sizes)
            rest = w == known.classes
            sums = lambda x: np.bincount(doc, weights=x, minlength=n)
            edge, rare = np.concatenate([[0], np.cumsum(sizes)]), []
            unplaced = np.flatnonzero(~placed)
            cut_at = np.searchsorted(unplaced, edge)
            for a, b in zip(cut_at[:-1], cut_at[1:], strict=True):
                rare.append([{"token": t, "times": c} for t, c in Counter(words[i] for i in unplaced[a:b]).items()])
            yield {
                "row": row + np.arange(n), "doc_id": batch.column("doc_id").slice(at, n), "n_tokens": sizes, "rare": rare,
                "n_known": sums(placed & (known.count[np.maximum(numbers, 0)] > 0)).astype(np.int64), "n_unplaced": sums(rest).astype(np.int64),
                "base": sums(log_count), "model": sums(by_model + np.where(rest, log_count, 0.0)),
            }
            row += n

    return map_arrow(docs, ["doc_id", "text"], per_task, SCORED)


def score(docs: DataFrame, classes: int = 1_000, head: int = 200_000, dim: int = 16) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per document."""
    fold = remainder("doc_id", 7)
    learned = docs.where(F.coalesce(fold != 2, F.lit(False)))
    counts = cut(count_tokens(learned))
    known = vocabulary(counts, classes, head)
    model = train(learned, known, dim=dim)
    scored = cut(_score(docs, known, model))
    rare = scored.select("row", F.explode("rare").alias("t")).select("row", "t.token", "t.times")
    found = rare.join(counts, "token").groupBy("row").agg(F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("logs"))
    both = scored.drop("rare").join(found, "row", "left").na.fill({"known": 0, "logs": 0.0})
    norm, rest = math.log10(known.total + known.distinct + 1), math.log10(known.rest_total + known.rest_distinct + 1)
    return both.select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "n_tokens", (F.col("n_known") + F.col("known")).alias("n_known"), F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("logs") - F.col("n_tokens") * F.lit(norm)).alias("base_score"), (F.col("model") + F.col("logs") - F.col("n_unplaced") * F.lit(rest)).alias("score"),
    )
