"""Near-duplicate classes: BagMinHash signatures, bands, exact verification of weighted Jaccard >= 0.8.

Plan (nothing is collected; each step that is used twice is written to the shared folder):
1. One pass over the texts gives each a key (digest of its words) and its band hashes. Texts with equal words are one
   node from here on, so groups of exact copies cost one row each.
2. Shingle multisets are built for the nodes that share a band with another, and the weight that each has in shingles
   of no other such node is summed. What is left, its shareable weight, bounds its similarity to anything: a node with
   under 0.8 of its weight shareable has no link and leaves.
3. Each band's nodes get a pivot, the one with the largest shareable share (a text that others were copied from has
   most), by a partial aggregate; every member is verified against the pivot only (a star, not all pairs).
4. Components of the verified stars. Bands whose members now lie in one component are done, whatever their size.
5. In the other bands, pairs across components are verified, but for those that are ruled out exactly: weighted Jaccard
   distance is a metric, so two members whose distances to the pivot differ by more than 0.2 can't be within 0.2; and
   two members share at most min(s, s') of their weights w + w', where s now leaves out the shingles that lie within
   one component, and at most min(i, i') + min(r, r'), where i is shared with the pivot and r is the shareable rest.
   So every pair that shares a band is linked, verified, or ruled out exactly; there is no cap.
6. Components of all links; the class of a document is the smallest doc_id of its component.

With 24 bands of 4 registers a pair of similarity 0.8 shares no band with probability 3e-6.

Defined cases: null text is empty; texts without words are equal only to the same text; texts of under five words are
one shingle; null ids get the class of their text (its smallest id, null if none); repeated rows are copies; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, Scratch, cut, map_arrow, shielded, text_bytes
from .components import components
from .shingles import band_hashes, overlap, pack_multiset, shingle_runs, signatures, unpack_multiset

BANDS, ROWS = 24, 4
CHUNK_BYTES = 2_000_000


def node_key(data: bytes) -> bytes:
    words = data.translate(ALNUM).split()
    return hashlib.md5(b" ".join(words) if words else b"\0" + data).digest()


def _chunks(texts: list[bytes]):
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) < CHUNK_BYTES):
            size += len(texts[stop])
            stop += 1
        yield at, stop
        at = stop


def sketch(docs: DataFrame, size: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, key, bands (null for a text without words)."""

    def per_task(batches):
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            for at, stop in _chunks(texts):
                part = texts[at:stop]
                doc, shingles, counts = shingle_runs(part, size)
                signature = signatures(doc, shingles, counts, len(part), bands * rows)
                hashes, has = band_hashes(signature, bands, rows), np.bincount(doc, minlength=len(part)) > 0
                offsets = np.concatenate([[0], np.cumsum(has * bands)]).astype(np.int32)
                values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes[has].ravel()))
                yield {"doc_id": batch.column("doc_id").slice(at, stop - at), "key": [node_key(t) for t in part], "bands": values}

    return map_arrow(docs, ["doc_id", "text"], per_task, "doc_id bigint, key binary, bands array<bigint>")


def _multisets(docs: DataFrame, needed: DataFrame, size: int, most: int = 2_000_000) -> DataFrame:
    """(nid, multiset, weight) of the nodes in needed (nid, key, doc_id). Texts are only moved if their ids are more than
    can be broadcast."""
    ids = needed.select(F.col("doc_id").alias("__id")).distinct()
    if needed.count() <= most:
        ids = F.broadcast(ids)
    few = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")

    def per_task(batches):
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            for at, stop in _chunks(texts):
                part = texts[at:stop]
                doc, shingles, counts = shingle_runs(part, size)
                edge = np.searchsorted(doc, np.arange(len(part) + 1))
                yield {
                    "key": [node_key(t) for t in part], "weight": np.bincount(doc, weights=counts, minlength=len(part)).astype(np.int64),
                    "multiset": [pack_multiset(shingles[a:b], counts[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)],
                }

    built = map_arrow(few, ["text"], per_task, "key binary, multiset binary, weight bigint")
    return built.join(needed.select("key", "nid"), "key").select("nid", "multiset", "weight").dropDuplicates(["nid"])


def _shingle_rows(multisets: DataFrame) -> DataFrame:
    """(nid, shingle, c) of the multisets."""

    def per_task(batches):
        for batch in batches:
            for nid, data in zip(batch.column("nid").to_pylist(), batch.column("multiset").to_pylist(), strict=True):
                shingles, counts = unpack_multiset(data)
                yield {"nid": np.full(len(shingles), nid), "shingle": shingles.view(np.int64), "c": counts}

    return map_arrow(multisets, ["nid", "multiset"], per_task, "nid bigint, shingle bigint, c bigint")


def _own_weights(multisets: DataFrame) -> DataFrame:
    """(nid, own): the weight of each node in shingles that no other node has."""
    alone = _shingle_rows(multisets).groupBy("shingle").agg(F.count("*").alias("n"), F.min("nid").alias("nid"), F.sum("c").alias("c")).where("n = 1")
    return alone.groupBy("nid").agg(F.sum("c").alias("own"))


def _inner_weights(multisets: DataFrame, places: DataFrame) -> DataFrame:
    """(nid, inner): the weight of each node of places (nid, c) in shingles of no other component than its own c.
    The shingle rows are made twice rather than written."""
    rows = _shingle_rows(multisets.join(places.select("nid"), "nid", "left_semi")).join(places.withColumnRenamed("c", "comp"), "nid")
    inner = rows.groupBy("shingle").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo = hi").select("shingle")
    return rows.join(inner, "shingle", "left_semi").groupBy("nid").agg(F.sum("c").alias("inner"))


def _verified(pairs: DataFrame, multisets: DataFrame) -> DataFrame:
    """pairs (a, b) with their similarity."""
    left = multisets.select(F.col("nid").alias("a"), F.col("multiset").alias("x"))
    right = multisets.select(F.col("nid").alias("b"), F.col("multiset").alias("y"))

    def per_task(batches):
        for batch in batches:
            pair = zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)
            yield {"a": batch.column("a"), "b": batch.column("b"), "similarity": [overlap(x, y) for x, y in pair]}

    return map_arrow(pairs.join(left, "a").join(right, "b"), ["a", "b", "x", "y"], per_task, "a bigint, b bigint, similarity double")


#: Bits of a node's number; the bits above hold the share that ranks pivots.
_NID_BITS = 53


def near_duplicates(docs: DataFrame, threshold: float = 0.8, size: int = 5) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of its class), key: one row per document."""
    scratch = Scratch()
    cut, drop = scratch.cut, scratch.drop
    sketched = cut(sketch(docs, size))
    nodes = sketched.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    nodes = cut(nodes.withColumn("nid", F.monotonically_increasing_id()))
    owners = cut(sketched.select("doc_id", "key"))
    drop(sketched)
    banded = nodes.select("nid", F.explode("bands").alias("band"))
    shared = cut(banded.groupBy("band").count().where("count > 1").select("band"))
    together = cut(banded.join(shared, "band").select("band", "nid"))
    drop(shared)
    wanted = cut(together.select("nid").distinct().join(nodes.select("nid", "key", "doc_id"), "nid"))
    multisets = cut(_multisets(docs, wanted, size))
    drop(wanted)

    stats = multisets.select("nid", "weight").join(_own_weights(multisets), "nid", "left").na.fill({"own": 0})
    able = F.col("weight") - F.col("own")
    stats = cut(stats.select("nid", "weight", able.alias("able")).where(able >= threshold * F.col("weight") - 1e-9))
    placed = together.join(stats, "nid")
    rank = F.shiftleft(F.floor(1023 * (1 - F.col("able") / F.col("weight"))).cast("long"), _NID_BITS).bitwiseOR(F.col("nid"))
    pivots = placed.groupBy("band").agg(F.min(rank).alias("rank"), F.count("*").alias("n")).where("n > 1")
    pivots = pivots.select("band", F.col("rank").bitwiseAND(F.lit((1 << _NID_BITS) - 1)).alias("b"))
    pivots = cut(pivots.join(stats.select(F.col("nid").alias("b"), F.col("weight").alias("wp")), "b").select("band", "b", "wp"))
    members = cut(placed.join(pivots, "band").withColumnRenamed("nid", "a"))
    drop(together, stats, pivots)
    tested = cut(_verified(members.where("a <> b").select("a", "b").distinct(), multisets))
    links = cut(tested.where(F.col("similarity") >= threshold).select("a", "b"))
    stage = components(links)

    # What the stars leave open: members of one band in different components that neither bound rules out.
    open_ = members.join(tested, ["a", "b"], "left").join(stage, F.col("a") == F.col("node"), "left")
    s = F.coalesce("similarity", F.lit(1.0))
    # The weight that a member shares with the pivot, and the shareable rest.
    with_pivot = s * (F.col("weight") + F.col("wp")) / (1 + s)
    open_ = cut(open_.select("band", "a", "weight", "able", s.alias("s"), with_pivot.alias("i"), (F.col("able") - with_pivot).alias("r"), F.coalesce("component", "a").alias("c")))
    drop(members, tested)
    torn = open_.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("band")
    rest = cut(open_.join(torn, "band", "left_semi"))
    drop(open_)
    if rest.isEmpty():
        final = stage
    else:
        inner = _inner_weights(multisets, cut(rest.select(F.col("a").alias("nid"), "c").distinct()))
        left = rest.join(inner, F.col("a") == F.col("nid"), "left").na.fill({"inner": 0}).withColumn("able", F.col("weight") - F.col("inner"))
        left = left.where((F.col("s") < 1.0) & (F.col("able") >= threshold * F.col("weight") - 1e-9)).drop("nid", "inner")
        left = cut(left.join(nodes.select(F.col("nid").alias("a"), "bands"), "a"))
        drop(rest)
        names = ("s", "c", "weight", "able", "i", "r", "bands")
        x, y = (left.select("band", F.col("a").alias(n), *[F.col(c).alias(f"{c}_{n}") for c in names]) for n in ("a", "b"))
        most = F.least("able_a", "able_b", F.least("i_a", "i_b") + F.least("r_a", "r_b"))
        near = (F.abs(F.col("s_a") - F.col("s_b")) <= 1 - threshold + 1e-9) & (most >= threshold * (F.col("weight_a") + F.col("weight_b") - most) - 1e-6)
        # A pair of several bands is made in the first of them only; there it is verified or ruled out once and for all.
        once = F.col("band") == F.array_min(F.array_intersect("bands_a", "bands_b"))
        across = x.join(y, "band").where((F.col("c_a") < F.col("c_b")) & near & once).select("a", "b")
        more = cut(_verified(across, multisets).where(F.col("similarity") >= threshold).select("a", "b"))
        final = components(links.unionByName(more))
    drop(multisets)

    own = cut(nodes.join(final, F.col("nid") == F.col("node"), "left").select("key", "doc_id", F.coalesce("component", "nid").alias("c")))
    first = own.groupBy("c").agg(F.min("doc_id").alias("class_id"))
    classes = cut(own.join(first, "c").select("key", "class_id"))
    scratch.drop_all(but=(owners, classes))
    return owners.select("doc_id", "key").join(classes, "key").select("doc_id", "class_id", "key")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, in their own columns, of which each is the first of its class. Of rows that repeat a doc_id and
    its text one stays; of rows with a null id one stays for each text whose class has no id."""
    return shielded(docs, ("doc_id", "text"), _keep_one)


def _keep_one(docs: DataFrame) -> DataFrame:
    found = cut(near_duplicates(docs))
    keep = cut(found.where("doc_id = class_id").select(F.col("doc_id").alias("__id")).distinct())
    kept = docs.join(keep, F.col("doc_id") == F.col("__id"), "left_semi")
    again = cut(found.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__id")).count().where("count > 1").select("__id"))
    if not again.isEmpty():
        once = kept.join(again, F.col("doc_id") == F.col("__id"), "left_anti")
        order = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.lit(0))
        more = kept.join(again, F.col("doc_id") == F.col("__id"), "left_semi").withColumn("__row", F.row_number().over(order)).where("__row = 1").drop("__row")
        kept = once.unionByName(more)
    alone = found.where("doc_id IS NULL AND class_id IS NULL").select("key").distinct()
    return kept if alone.isEmpty() else kept.unionByName(_without_id(docs, alone))


def _without_id(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The documents without an id whose class has none, one for each text."""
    schema = T.StructType([*docs.schema.fields, T.StructField("__key", T.BinaryType())])

    def per_task(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([node_key(t) for t in text_bytes(batch.column("text"))], type=pa.binary())], names=schema.names)

    keyed = docs.where("doc_id IS NULL").mapInArrow(per_task, schema)
    return keyed.join(keys.withColumnRenamed("key", "__key"), "__key", "left_semi").dropDuplicates(["__key"]).select(*docs.columns)
