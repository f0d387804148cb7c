"""Packing of documents into sequences by Karmarkar-Karp multiway differencing.

A document is tokenised whole; its full windows leave at once as sequences of their own, and its last piece joins a
group. Each group is packed by multiway differencing: the two partial partitions with the largest imbalance merge, the
fullest windows of one on the emptiest of the other, until one is left; if a window exceeds the capacity the window
count rises by one. The windows stay as differencing made them. Before it, just so many pieces are held back for the next
group that the others nearly fill a whole number of windows (all but a slack of some tokens a window, larger where the count would rise); after it, the small gaps
are closed with last pieces of documents of over a window, which are cut already, or with whole pieces held back.
So a document that fits a window is cut only if it is in the last remainder of its task, less than a window, which is cut
at powers of two and needs no padding.

All of this happens within a task, on a bounded group of pieces, without a shuffle; a retried task repeats its sequence
ids, which carry the partition number.

Tokens: white space is never part of a token of the word-level BPE, so texts are split at ASCII white space and every
distinct word of a lot is put together once, from words and tails whose ids are cached (bounded in bytes; when it is full,
those that no lot has met again are forgotten).

Defined cases: null text is empty, and an empty document is its end id alone; repeated and null ids pack like any other
row; extra columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import heapq
import os
import zlib
from array import array
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from .common import lots, map_arrow, text_bytes

SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


#: ASCII punctuation without the apostrophe, which may begin a token together with letters.
PUNCTUATION = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """bytes of a text -> little-endian uint32 ids as bytes, the same as encoding the whole text.

    A word that ends in ASCII punctuation after an ASCII letter or digit is put together from its core and its tail
    (the tokenizer splits there too), and purely alphabetic words are encoded many to a call: each is one run of
    letters, so it ends at the next id that ends a word. Case of A-Z does not matter to the tokenizer; texts that may
    hold a special token are left as they are.
    """

    def __init__(self, path: str, max_bytes: int = 144 << 20) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.max_bytes = Tokenizer.from_file(path), max_bytes
        # Ids of words, about how much room they take, and the words met again since some were last forgotten.
        self.known: dict[bytes, bytes] = {}
        self.size, self.again = 0, set()
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends_word[i] = token.endswith("</w>")

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[bytes]) -> None:
        single = []
        letters = []
        for w in words:
            (letters if (t := w.decode()).isalpha() else single).append((w, t))
        for at in range(0, len(letters), 2_000):
            part = letters[at : at + 2_000]
            ids = np.array(self._ids([" ".join(t for _, t in part)])[0], dtype="<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(part) or ends[-1] != len(ids):  # a letter that the tokenizer takes apart
                single += part
                continue
            data, start = ids.tobytes(), 0
            for (w, _), end in zip(part, (4 * ends).tolist(), strict=True):
                self.known[w] = data[start:end]
                start = end
        for at in range(0, len(single), 10_000):
            part = single[at : at + 10_000]
            for (w, _), ids in zip(part, self._ids([t for _, t in part]), strict=True):
                self.known[w] = array("I", ids).tobytes()

    def learn(self, atoms: set[bytes]) -> None:
        """Have the ids of all these words in the cache."""
        new = atoms.difference(self.known)
        met = atoms - new
        self.again |= met
        room = _ENTRY * len(new) + 3 * sum(map(len, new))
        if self.size + room > self.max_bytes:
            keep = self.again if len(self.again) * 2 * _ENTRY < self.max_bytes else met
            self.known = {w: self.known[w] for w in keep}
            self.size, self.again = _ENTRY * len(keep) + 3 * sum(map(len, keep)), set()
        self.size += room
        self._encode_words(list(new))

    def table(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The ids of each of these words."""
        composed, atoms = [], set()
        for w in words:
            core = w.rstrip(PUNCTUATION)
            if len(core) < len(w) and core and core[-1] < 128 and core[-1:].isalnum() and b"<|" not in w:
                composed.append((w, core, tail := w[len(core) :]))
                atoms.add(core)
                atoms.add(tail)
            else:
                atoms.add(w)
        self.learn(atoms)
        known = self.known
        out = {a: known[a] for a in atoms}
        for w, core, tail in composed:
            out[w] = known[core] + known[tail]
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        ids = self.table(set().union(*split)).__getitem__
        return [b"".join(map(ids, s)) for s in split]


#: About the bytes of a cached word beside its letters and ids.
_ENTRY = 150
_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


@dataclass(slots=True)
class Piece:
    doc_id: int | None
    ids: bytes
    start: int
    length: int
    doc_tokens: int

    def split(self, at: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.ids[: 4 * at], self.start, at, self.doc_tokens),
            Piece(self.doc_id, self.ids[4 * at :], self.start + at, self.length - at, self.doc_tokens),
        )


def differencing(lengths: list[int], m: int) -> list[list[int]]:
    """Karmarkar-Karp: indices of lengths in m near-equal parts."""
    if not lengths:
        return [[] for _ in range(m)]
    # A partial partition: (minus its imbalance, tie-break, loads from large to small less the smallest, parts).
    heap = [(-n, i, [n] + [0] * (m - 1), [[i]] + [[] for _ in range(m - 1)]) for i, n in enumerate(lengths)]
    if m == 1:
        return [list(range(len(lengths)))]
    heapq.heapify(heap)
    tie = len(heap)
    while len(heap) > 1:
        _, _, a, pa = heapq.heappop(heap)
        _, _, b, pb = heapq.heappop(heap)
        merged = sorted(zip(map(int.__add__, a, reversed(b)), map(list.__add__, pa, reversed(pb)), strict=True), key=lambda x: -x[0])
        least = merged[-1][0]
        loads = [x[0] - least for x in merged]
        heapq.heappush(heap, (-loads[0], tie, loads, [x[1] for x in merged]))
        tie += 1
    return heap[0][3]


def windows(lengths: list[int], capacity: int, most: int | None = None) -> list[list[int]]:
    """The fewest windows that differencing fits under the capacity, from the least possible count upwards; none if they
    are over `most`."""
    m = max(1, -(-sum(lengths) // capacity))
    while most is None or m <= most:
        parts = differencing(lengths, m)
        if all(sum(lengths[i] for i in part) <= capacity for part in parts):
            return parts
        m += 1
    return []


def held_back(pieces: list[Piece], room: int) -> tuple[list[Piece], list[Piece]]:
    """(taken, held): pieces that sum to room at most, and near it; at least one is taken."""
    over = sum(p.length for p in pieces) - room
    taken, held = [], []
    for p in sorted(pieces, key=lambda p: -p.length):
        if p.length <= over:
            held.append(p)
            over -= p.length
        else:
            taken.append(p)
    if over > 0 and len(taken) > 1:
        held.append(taken.pop())
    return taken, held


def close_gaps(parts: list[list[Piece]], spare: list[Piece], capacity: int) -> list[Piece]:
    """Fill windows with spare pieces: those of documents that are cut anyway are cut to measure, others go whole or not
    at all. What is left of the spare ones is returned."""
    cuttable = sorted((p for p in spare if p.doc_tokens > capacity), key=lambda p: p.length)
    whole = sorted((p for p in spare if p.doc_tokens <= capacity), key=lambda p: p.length)
    sizes = [p.length for p in whole]
    for part in parts:
        gap = capacity - sum(p.length for p in part)
        while gap and (at := bisect_right(sizes, gap)):
            part.append(whole.pop(at - 1))
            gap -= sizes.pop(at - 1)
        while gap and cuttable:
            piece = cuttable.pop()
            if piece.length > gap:
                piece, rest = piece.split(gap)
                cuttable.append(rest)
            part.append(piece)
            gap -= piece.length
    return whole + cuttable


def pack_group(pieces: list[Piece], capacity: int, slacks: tuple[int, ...] = (24, 64, 96, 128)) -> tuple[list[list[Piece]], list[Piece]]:
    """Windows over most of the pieces, and the pieces that wait for the next group."""
    total = sum(p.length for p in pieces)
    if total < capacity:
        return [], pieces
    # Pieces of long documents, more than the gaps should take, stay out of the windows.
    fill, room = [], 4 * capacity
    for p in sorted((p for p in pieces if p.doc_tokens > capacity), key=lambda p: p.length):
        if room <= 0 or total - p.length < capacity:
            break
        fill.append(p)
        room -= p.length
        total -= p.length
    aside = {id(p) for p in fill}
    rest, count = [p for p in pieces if id(p) not in aside], max(1, total // capacity)
    for slack in slacks:
        taken, held = held_back(rest, count * (capacity - slack))
        found = windows([p.length for p in taken], capacity, most=count if slack < slacks[-1] else None)
        if found:
            break
    parts = [[taken[i] for i in part] for part in found]
    return parts, close_gaps(parts, fill + held, capacity)


def powers_of_two(pieces: list[Piece], capacity: int) -> list[list[Piece]]:
    """Sequences of falling powers of two over the pieces in turn: no padding."""
    left, out, queue = sum(p.length for p in pieces), [], pieces[::-1]
    while left:
        want = min(capacity, 1 << (left.bit_length() - 1))
        left -= want
        out.append([])
        while want:
            piece = queue.pop()
            if piece.length > want:
                piece, rest = piece.split(want)
                queue.append(rest)
            out[-1].append(piece)
            want -= piece.length
    return out


def pack(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = 4096, end_id: int = 2, group: int = 128) -> DataFrame:
    """A row per piece; see SCHEMA. `group` bounds the pieces packed together (time and memory of one differencing)."""
    path = tokenizer_path or default_tokenizer()

    def per_task(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << 40
        end = end_id.to_bytes(4, "little")
        waiting: list[Piece] = []
        rows: dict[str, list] = {}

        def clear():
            rows.update({k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")})

        def emit(parts):
            nonlocal sequence
            for part in parts:
                offset = 0
                for p in part:
                    for k, v in (("doc_id", p.doc_id), ("start", p.start), ("length", p.length), ("ids_crc32", zlib.crc32(p.ids)), ("doc_tokens", p.doc_tokens), ("sequence_id", sequence), ("offset", offset)):
                        rows[k].append(v)
                    offset += p.length
                sequence += 1

        def settle():
            parts, waiting[:] = pack_group(waiting, capacity)
            emit(parts)

        clear()
        for batch in batches:
            # Lots that bound what is encoded at once, whatever the batch holds.
            for lot in lots(batch, 4_000_000):
                for doc_id, ids in zip(lot.column("doc_id").to_pylist(), encoder(path).encode(text_bytes(lot.column("text"))), strict=True):
                    ids += end
                    n = len(ids) // 4
                    whole = n - n % capacity
                    for start in range(0, whole, capacity):
                        emit([[Piece(doc_id, ids[4 * start : 4 * (start + capacity)], start, capacity, n)]])
                    if n > whole:
                        waiting.append(Piece(doc_id, ids[4 * whole :], whole, n - whole, n))
                    if len(waiting) >= group:
                        settle()
            if len(rows["start"]) >= 5_000:
                yield {**rows}
                clear()
        while sum(p.length for p in waiting) >= capacity:
            settle()
        emit(powers_of_two(waiting, capacity))
        if rows["start"]:
            yield {**rows}

    return map_arrow(docs, ["doc_id", "text"], per_task, SCHEMA)
