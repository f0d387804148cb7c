"""Benchmark decontamination with one Aho-Corasick automaton per benchmark block.

Texts and items are normalised to words (runs of 0-9, a-z and non-ASCII after lowering A-Z). Benchmark words are
numbered; a pattern of the automaton is the number sequence of a window (13 consecutive item words, or the whole item
if it is shorter), so one pass over a document's word numbers finds every window, and a word index maps straight back
to an offset in the original text.

Size: the automaton is broadcast, so it is bounded: `max_windows` windows a block. A benchmark with more windows is
scanned in several blocks, one after another (each adds to the hits of the one before, and what it found is written to
the shared folder before the next begins), so nothing is dropped and a worker holds one automaton at a time. There is no
shuffle; with one block, text never leaves its task.

Defined cases: null or wordless text has n_words 0 and no hits; null or wordless items have no window; items with a
null id hit words but are not listed; repeated items count once by id; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, Scratch, map_arrow, release, shielded, text_bytes

WINDOW = 13
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Columns that the scan adds to a row.
FLAGS = {"__n_words": T.LongType(), "__n_hit": T.LongType(), "__hits": T.BinaryType(), "__items": T.ArrayType(T.LongType())}


def words(data: bytes) -> list[bytes]:
    return data.translate(ALNUM).split()


def word_blocks(benchmark: DataFrame, window: int, max_windows: int) -> Iterator[dict[tuple[bytes, ...], list]]:
    """Blocks of {window words: item ids}, each of max_windows windows at most, streamed to the driver."""
    block: dict[tuple[bytes, ...], list] = {}
    for row in benchmark.select("item_id", "text").toLocalIterator():
        item = words((row["text"] or "").encode())
        for i in range(max(1, len(item) - window + 1) if item else 0):
            ids = block.setdefault(tuple(item[i : i + window]), [])
            if row["item_id"] is not None and row["item_id"] not in ids:
                ids.append(row["item_id"])
        if len(block) >= max_windows:
            yield block
            block = {}
    if block:
        yield block


_built: dict[str, tuple] = {}


def automaton(key: str, block: dict[tuple[bytes, ...], list]) -> tuple:
    """The automaton over word numbers and the numbering, built once a worker process."""
    if key not in _built:
        _built.clear()
        number: dict[bytes, int] = {}
        found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for pattern, ids in block.items():
            numbers = tuple(number.setdefault(w, len(number) + 1) for w in pattern)
            found.add_word(numbers, (len(numbers), ids))
        if block:
            found.make_automaton()
        _built[key] = found, number
    return _built[key]


def hit_words(found, number: dict[bytes, int], data: bytes) -> tuple[int, bytearray, set]:
    """Word count, a flag for each word (empty if none is hit), and the items whose windows occur."""
    doc = words(data)
    hits, items = bytearray(), set()
    for end, (length, ids) in found.iter(tuple(map(number.get, doc, repeat(0)))) if doc and number else ():
        hits = hits or bytearray(len(doc))
        hits[end + 1 - length : end + 1] = b"\1" * length
        items.update(ids)
    return len(doc), hits, items


def spans_of(text: str, hits: bytes) -> list[dict]:
    """Runs of hit words as code-point spans of the original text."""
    out: list[dict] = []
    joined = False
    for hit, m in zip(hits, _WORD.finditer(text), strict=True):
        if hit and joined:
            out[-1]["end"] = m.end()
        elif hit:
            out.append({"start": m.start(), "end": m.end()})
        joined = bool(hit)
    return out


def _scan_block(docs: DataFrame, block: dict, first: bool) -> DataFrame:
    """docs with its own columns and __n_words, __n_hit, __hits (a byte a word), __items added or brought up to date."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    key = hashlib.sha1(repr(sorted(block.items())).encode()).hexdigest()
    own = [c for c in docs.columns if c not in FLAGS]
    schema = T.StructType([docs.schema[c] for c in own] + [T.StructField(k, t) for k, t in FLAGS.items()])

    def per_task(batches):
        found, number = automaton(key, shared.value)
        for batch in batches:
            out = {k: [] for k in FLAGS}
            earlier = [(None, None)] * batch.num_rows if first else zip(batch.column("__hits").to_pylist(), batch.column("__items").to_pylist(), strict=True)
            for data, (was, ids) in zip(text_bytes(batch.column("text")), earlier, strict=True):
                count, hits, items = hit_words(found, number, data)
                if was:
                    hits = bytes(map(max, hits or bytes(count), was))
                for k, v in zip(FLAGS, (count, sum(hits), bytes(hits) or None, sorted(items.union(ids or ()))), strict=True):
                    out[k].append(v)
            columns = [batch.column(c) for c in own] + [pa.array(out[k], type=t) for k, t in zip(FLAGS, (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[*own, *FLAGS])
        release()

    return docs.select(*own, *([] if first else FLAGS)).mapInArrow(per_task, schema)


def flagged(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_windows: int = 100_000) -> DataFrame:
    """docs with what the scan found on each row; rows are judged one by one, so repeated or null ids need no join."""
    scanned, written, scratch = None, None, Scratch()
    for block in word_blocks(benchmark, window, max_windows):
        if scanned is not None:
            was, written = written, scratch.cut(scanned)
            if was is not None:
                scratch.drop(was)
        scanned = _scan_block(docs if written is None else written, block, written is None)
    return _scan_block(docs, {}, True) if scanned is None else scanned


def verdict(min_share: float = 0.05):
    return (F.col("__n_hit") > 0) & (F.col("__n_hit") * F.lit(round(1 / min_share)) >= F.col("__n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_windows: int = 100_000, min_share: float = 0.05) -> DataFrame:
    """One row per document: word counts, hit words, items, spans in the original text, and the verdict
    (n_hit > 0 and n_hit >= min_share * n_words)."""
    scanned = flagged(docs.select("doc_id", "text"), benchmark, window, max_windows)

    def located(batches):
        for batch in batches:
            texts = batch.column("text")
            spans = [spans_of(texts[i].as_py(), hits) if hits else [] for i, hits in enumerate(batch.column("__hits").to_pylist())]
            yield {"doc_id": batch.column("doc_id"), "n_words": batch.column("__n_words"), "n_hit": batch.column("__n_hit"), "item_ids": batch.column("__items"), "contaminated": batch.column("contaminated"), "spans": spans}

    found = map_arrow(
        scanned.withColumn("contaminated", verdict(min_share)), ["doc_id", "text", "__n_words", "__n_hit", "__hits", "__items", "contaminated"], located,
        "doc_id bigint, n_words bigint, n_hit bigint, item_ids array<bigint>, contaminated boolean, spans array<struct<start:bigint,end:bigint>>",
    )
    listed = F.array_join(F.array_sort(F.transform("item_ids", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"), "contaminated", "item_ids", "spans")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, in their own columns."""
    return shielded(docs, ("doc_id", "text"), lambda d: flagged(d, benchmark).where(~verdict()))
