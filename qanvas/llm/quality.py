"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(b + sum w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]): all pairwise interactions of rank
`rank` in time linear in the features, by the sum-of-squares identity.

Features of a text: its distinct lower-cased words, hashed, each of weight 1/sqrt(their number); one-hot bins of
structure statistics (length, symbols, case, digits, repeated words and lines, line and word lengths, ...); one-hot bins
of the metadata columns named (only n_chars by default: never ids, language, source or labels).

Training: labelled rows outside the held-out fold, at most `max_train_rows` of them, those of smallest hash (the
documented bound of the sample). Their features are taken on the executors, and come to the driver, where numpy trains
by Adagrad. Scoring is one pass without a shuffle; the model (a few MB, fixed by its parameters) is broadcast.

Defined cases: null text is empty and scored like any other; null metadata is its own bin; a repeated id with labels
that differ counts by their mean (ties are 1); null labels and ids teach nothing; no labels give 0.5 for all; extra
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, remainder, shielded, sigmoid, text_bytes

WORD_BITS = 18
STRUCTURE_BINS = 4096
SIZE = (1 << WORD_BITS) + STRUCTURE_BINS
_SYMBOLS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
_UPPER, _DIGIT = bytes(range(0x41, 0x5B)), bytes(range(0x30, 0x3A))


class Features:
    """Texts to rows of (feature numbers, weights); hashes of words are cached within bounds."""

    def __init__(self, max_words: int = 300_000) -> None:
        self.known: dict[bytes, int] = {}
        self.max_words = max_words

    def words(self, distinct: set[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.max_words:
            known.clear()
        for w in filterfalse(known.__contains__, distinct):
            known[w] = zlib.crc32(w) & ((1 << WORD_BITS) - 1)
        return np.unique(np.fromiter(map(known.__getitem__, distinct), dtype=np.int64, count=len(distinct)))

    def row(self, text: bytes, metadata: tuple) -> tuple[np.ndarray, np.ndarray]:
        words = text.split()
        hashed = self.words(set(text.lower().split()))
        structure = np.array([(1 << WORD_BITS) + slot * 32 + b for slot, b in enumerate([*structure_bins(text, words), *map(metadata_bin, metadata)])], dtype=np.int64)
        ids = np.concatenate([hashed, structure])
        x = np.ones(len(ids), dtype=np.float32)
        x[: len(hashed)] = 1.0 / np.sqrt(max(1, len(hashed)))
        return ids, x


def _log_bin(n: float) -> int:
    return int(min(31, 2 * np.log2(n + 1)))


def _share_bin(part: float, whole: float) -> int:
    """Fine near 0, where most shares lie."""
    return int(min(31, 31.99 * (part / whole) ** 0.5)) if whole else 0


def structure_bins(text: bytes, words: list[bytes]) -> list[int]:
    n, count = len(text), len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    plain = n - len(text.translate(None, _SYMBOLS))
    letters = len(text.translate(None, _SYMBOLS + _DIGIT + b" \n\t\r"))
    distinct = len(set(words))
    common = Counter(words).most_common(1)[0][1] if words else 0
    odd = sum(1 for w in words if w[-1] in b"!#$%&*|" or w[0] in b"!#$%&*|")
    return [
        _log_bin(n), _log_bin(count), _share_bin(plain, n), _share_bin(n - len(text.translate(None, _UPPER)), letters), _share_bin(n - len(text.translate(None, _DIGIT)), n),
        _share_bin(distinct, count), _share_bin(common, count), _share_bin(len(set(lines)), len(lines)), _log_bin(len(lines)), _log_bin(count / max(1, len(lines))),
        int(min(31, 2 * letters / max(1, count))), _share_bin(odd, count), _share_bin(text.count(b"|"), count), _share_bin(text.count(b"!"), count),
        _share_bin(text.count(b"."), count), _share_bin(sum(map(len, words)) and max(map(len, words)), n), _share_bin(len(re.findall(rb"(?:https?://|www\.|@)", text)), count),
        _share_bin(n - letters - plain, n),
    ]


def metadata_bin(value) -> int:
    """Numbers by size, anything else by hash; null is bin 0."""
    if value is None:
        return 0
    return 1 + (_log_bin(max(0.0, float(value))) * 30) // 31 if isinstance(value, int | float) and value == value else 1 + zlib.crc32(str(value).encode()) % 31


class Machine:
    """The factorisation machine."""

    def __init__(self, size: int = SIZE, rank: int = 8, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.b, self.w = 0.0, np.zeros(size, dtype=np.float32)
        self.v = rng.normal(0, 0.01, (size, rank)).astype(np.float32)

    def raw(self, ids: np.ndarray, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Linear-time scores of rows laid end to end; every row has features."""
        vx = self.v[ids] * x[:, None]
        s = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat((vx**2).sum(axis=1), starts)
        return self.b + np.add.reduceat(self.w[ids] * x, starts) + 0.5 * ((s**2).sum(axis=1) - squares)

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = 12, batch: int = 128, rate: float = 0.08, decay: float = 2e-4, min_rows: int = 5, seed: int = 7) -> Machine:
        """Adagrad on the logistic loss. Words in fewer than min_rows rows stay untrained, with no weight."""
        rng = np.random.default_rng(seed)
        seen = np.bincount(np.concatenate([r[0] for r in rows]), minlength=len(self.w))
        self.v[seen < min_rows] = 0
        rows = [(i[seen[i] >= min_rows], x[seen[i] >= min_rows]) for i, x in rows]
        rows = [r if len(r[0]) else (np.zeros(1, np.int64), np.zeros(1, np.float32)) for r in rows]
        prior = np.clip(y.mean(), 0.01, 0.99)
        self.b = float(np.log(prior / (1 - prior)))
        gw, gv, gb = np.full(len(self.w), 1e-6), np.full(self.v.shape, 1e-6), 1e-6
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), batch):
                part = [rows[i] for i in order[at : at + batch]]
                n = np.array([len(r[0]) for r in part])
                starts = np.cumsum(n) - n
                ids, x = np.concatenate([r[0] for r in part]), np.concatenate([r[1] for r in part])
                error = sigmoid(self.raw(ids, x, starts)) - y[order[at : at + batch]]
                e = np.repeat(error, n) * x
                s = np.repeat(np.add.reduceat(self.v[ids] * x[:, None], starts, axis=0), n, axis=0)
                by = np.argsort(ids, kind="stable")
                new = np.flatnonzero(np.diff(ids[by], prepend=-1))
                own = ids[by][new]
                dw = np.add.reduceat(e[by], new) + decay * self.w[own]
                dv = np.add.reduceat((e[:, None] * (s - self.v[ids] * x[:, None]))[by], new, axis=0) + decay * self.v[own]
                gw[own] += dw**2
                gv[own] += dv**2
                gb += error.sum() ** 2
                self.w[own] -= rate * dw / np.sqrt(gw[own])
                self.v[own] -= rate / 2 * dv / np.sqrt(gv[own])
                self.b -= rate * error.sum() / np.sqrt(gb)
        return self


def labelled(labels: DataFrame, column: str, not_remainder: tuple[int, int], max_rows: int) -> DataFrame:
    """(__id, y) of the bounded training sample; small by its bound."""
    modulus, held_out = not_remainder
    y = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & (remainder("doc_id", modulus) != held_out))
    y = y.groupBy(F.col("doc_id").alias("__id")).agg((F.avg(F.col(column).cast("double")) >= 0.5).cast("int").alias("y"))
    return y.orderBy(F.xxhash64("__id"), "__id").limit(max_rows)


def fit(docs: DataFrame, labels: DataFrame, metadata: tuple[str, ...] = ("n_chars",), max_train_rows: int = 12_000) -> Machine | None:
    """None if there is nothing to learn from."""
    sample = labelled(labels, "quality", (4, 2), max_train_rows)
    rows = docs.select("doc_id", "text", *metadata).join(F.broadcast(sample), F.col("doc_id") == F.col("__id"))

    def per_task(batches):
        features = Features()
        for batch in batches:
            meta = list(zip(*[batch.column(m).to_pylist() for m in metadata], strict=True)) or [()] * batch.num_rows
            found = [features.row(t, m) for t, m in zip(text_bytes(batch.column("text")), meta, strict=True)]
            yield {"doc_id": batch.column("doc_id"), "y": batch.column("y"), "ids": [i.astype("<i4").tobytes() for i, _ in found], "x": [x.tobytes() for _, x in found]}

    got = map_arrow(rows, ["doc_id", "text", *metadata, "y"], per_task, "doc_id bigint, y int, ids binary, x binary").collect()
    if not got:
        return None
    got.sort(key=lambda r: (r["doc_id"], bytes(r["ids"])))
    data = [(np.frombuffer(r["ids"], "<i4").astype(np.int64), np.frombuffer(r["x"], "<f4")) for r in got]
    return Machine().fit(data, np.array([r["y"] for r in got], dtype=np.float64))


def with_quality(docs: DataFrame, labels: DataFrame, metadata: tuple[str, ...] = ("n_chars",), threshold: float = 0.7, max_train_rows: int = 12_000) -> DataFrame:
    """docs in their own columns, and __score and __predicted."""
    machine = fit(docs, labels, metadata, max_train_rows)
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    schema = T.StructType([*docs.schema.fields, T.StructField("__score", T.DoubleType()), T.StructField("__predicted", T.IntegerType())])

    def per_task(batches):
        features, model = Features(), shared.value
        for batch in batches:
            meta = list(zip(*[batch.column(m).to_pylist() for m in metadata], strict=True)) or [()] * batch.num_rows
            texts, score = text_bytes(batch.column("text")), np.full(batch.num_rows, 0.5)
            for at in range(0, len(texts) if model else 0, 256):
                found = [features.row(t, m) for t, m in zip(texts[at : at + 256], meta[at : at + 256], strict=True)]
                n = np.array([len(i) for i, _ in found])
                ids, x = np.concatenate([i for i, _ in found]), np.concatenate([x for _, x in found])
                score[at : at + 256] = sigmoid(model.raw(ids, x, np.cumsum(n) - n))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=schema.names)

    return docs.mapInArrow(per_task, schema)


def classify(docs: DataFrame, labels: DataFrame, metadata: tuple[str, ...] = ("n_chars",)) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = with_quality(docs.select("doc_id", "text", *metadata), labels, metadata)
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), F.col("__score").alias("score"), F.col("__predicted").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, in their own columns."""
    return shielded(docs, ("doc_id", "text", "n_chars"), lambda d: with_quality(d, labels).where("__predicted = 1"))
