"""Secret scans by grammar inference.

Base patterns mark credentials of three kinds. Their values are the labelled examples of a format. A value is seen in two
ways: as the alphabets of its parts (every letter or digit stands for the smallest alphabet - digits, hexadecimal, lower
case with digits, ... - that its run is made of, other characters for themselves), and as the classes of its characters.
By alphabets, random values of one format share a way through the prefix tree, so its states keep lengths and positions;
by classes, the same alphabet in another length is alike too. For each kind and view the tree is built from a sample, and
statistically compatible states are merged (red-blue order, Hoeffding bounds on ending and on every symbol, checked down
the subtrees) into a probabilistic automaton. One more is
learned from the candidates that no base pattern marks: one from runs of 16 or more with a digit, one from all others,
mostly words. Every candidate (a maximal run of 6 or more credential characters, the shortest value) outside the base spans is then scored: it is marked, as kind `learned`, where in either view a
kind's automaton finds it more likely than either background by `min_bits`, and as likely a symbol as all but a twentieth
of that kind's own examples.

Plan: one pass gathers, in each task, the `sample` distinct values of smallest hash per kind; the smallest of all tasks
follow by an ordered limit. So the sample is drawn over all documents and has a fixed size (automata are fitted to it:
the documented bound). A second pass, without a shuffle, marks all texts with the broadcast automata (a few hundred KB).

Defined cases: null text is empty; a kind with under `min_examples` distinct values gets no automaton; without a
background automaton a uniform one over printable symbols stands in; values longer than 512 are not learned from, but
scored; repeated and null ids are scanned like any other row; extra columns are ignored; offsets are code points.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, map_arrow, text_bytes

#: Fixed values of the contract: the base patterns, the least lengths and the order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "learned")

_IS_HEX = bytes(0x78 if b in b"0123456789abcdef" else 0x20 for b in range(256))
_CANDIDATE = re.compile(rb"[A-Za-z0-9+/_.=-]{6,}")
_DIGIT = re.compile(rb"[0-9]")
#: Classes of characters: digits, hexadecimal letters and other letters of either case; other characters stand for themselves.
_CLASS = {c: ("0" if c.isdigit() else "a" if c in "abcdef" else "g" if c.islower() else "A" if c in "ABCDEF" else "G" if c.isupper() else c) for c in map(chr, range(33, 127))}
_CLASSES = bytes(ord(_CLASS.get(chr(b), "?")) for b in range(256))
#: The alphabets, smallest first: the classes that a run may be made of, and the symbol of its characters.
ALPHABETS = [("0", "0"), ("0a", "h"), ("0A", "H"), ("0ag", "l"), ("0AG", "U"), ("0agAG", "x")]
_RUN = re.compile("[0agAG]+")


def symbols(look: str) -> str:
    """A value's classes as the alphabets of its runs."""
    return _RUN.sub(lambda m: next(s for those, s in ALPHABETS if not m[0].strip(those)) * len(m[0]), look)


def classes(value: str) -> str:
    return value.encode("latin-1", "replace").translate(_CLASSES).decode("latin-1")


def looks(value: str) -> str:
    return symbols(classes(value))


def base_spans(data: bytes) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of the base matches, by start and kind, in code points."""
    low, out, text = data.lower(), [], None
    if any(k in low for k in (b"passw", b"secret", b"token", b"api")):
        text = data.decode()
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if b"AKIA" in data:
        text = text or data.decode()
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if b"x" * 24 in data.translate(_IS_HEX):
        text = text or data.decode()
        out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, value) of the candidates, all maximal runs of at least the shortest value's length, in bytes."""
    for m in _CANDIDATE.finditer(data):
        yield m.start(), m.end(), m[0]


def points(data: bytes, at: int) -> int:
    """Code points before a byte."""
    return len(data[:at].decode())


def background(value: bytes) -> str:
    """Long runs with digits have a background of their own, which words would crowd out."""
    return "background" if len(value) >= 16 and _DIGIT.search(value) else "words"


class Automaton:
    """A probabilistic automaton: for each state its end count, its visits, and its symbols with next state and count."""

    def __init__(self, values: list[str], alpha: float = 0.05) -> None:
        self.visits, self.ends, self.next = [0], [0], [{}]
        for value in values:
            state = 0
            self.visits[0] += 1
            for s in value:
                if s not in self.next[state]:
                    self.next[state][s] = [len(self.next), 0]
                    self.visits.append(0)
                    self.ends.append(0)
                    self.next.append({})
                self.next[state][s][1] += 1
                state = self.next[state][s][0]
                self.visits[state] += 1
            self.ends[state] += 1
        self.width = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_states()
        each = sorted(self.bits(v) / (len(v) + 1) for v in values)
        self.typical = each[len(each) // 20] - 1e-9 if each else 0.0

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return n1 > 0 and n2 > 0 and abs(f1 / n1 - f2 / n2) > self.width * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            if self._differ(self.ends[a], self.visits[a], self.ends[b], self.visits[b]):
                return False
            for s in self.next[a].keys() | self.next[b].keys():
                x, y = self.next[a].get(s), self.next[b].get(s)
                if self._differ(x[1] if x else 0, self.visits[a], y[1] if y else 0, self.visits[b]):
                    return False
                if x and y:
                    stack.append((x[0], y[0]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below b to what is at and below a."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for s, (child, count) in self.next[b].items():
                if s in self.next[a]:
                    self.next[a][s][1] += count
                    stack.append((self.next[a][s][0], child))
                else:
                    self.next[a][s] = [child, count]

    def _merge_states(self) -> None:
        red = [0]
        while True:
            marked = set(red)
            blue = [(-count, child, state, s) for state in red for s, (child, count) in self.next[state].items() if child not in marked]
            if not blue:
                break
            _, child, state, s = min(blue)
            for r in red:
                if self._compatible(r, child):
                    self.next[state][s][0] = r
                    self._fold(r, child)
                    break
            else:
                red.append(child)
        number = {state: i for i, state in enumerate(red)}
        self.visits, self.ends = [self.visits[r] for r in red], [self.ends[r] for r in red]
        self.next = [{s: [number[c], n] for s, (c, n) in self.next[r].items()} for r in red]

    def bits(self, value: str, symbols: int = 16) -> float:
        """log2 of the probability of a value's symbols, with add-half smoothing; unseen symbols stay in place."""
        state, total = 0, 0.0
        for s in value:
            step = self.next[state].get(s)
            total += math.log2(((step[1] if step else 0) + 0.5) / (self.visits[state] + 0.5 * symbols))
            state = step[0] if step else state
        return total + math.log2((self.ends[state] + 0.5) / (self.visits[state] + 0.5 * symbols))


class Formats:
    """The automata of the kinds, and of the background, in two views of a value: the alphabets of its runs, which keep
    a format's lengths and positions, and its classes, which generalise over them. Long runs that look just as a
    twentieth or more of a kind's examples do are no background: they may be the same credentials without a key."""

    def __init__(self, examples: dict[str, list[str]], min_examples: int = 8, min_bits: float = 20.0) -> None:
        self.min_bits = min_bits
        shared = set()
        for kind, values in examples.items():
            if kind not in ("background", "words"):
                shared |= {look for look, n in Counter(map(looks, values)).items() if n >= max(2, len(values) / 20)}
        kept = examples | {"background": [v for v in examples.get("background", []) if looks(v) not in shared]}
        enough = {k: sorted(v) for k, v in sorted(kept.items()) if len(v) >= min_examples}
        #: (view, automata of the kinds, automata of the background)
        self.views = []
        for view in (looks, classes):
            automata = {k: Automaton([view(x) for x in v]) for k, v in enough.items()}
            grounds = [automata.pop(k) for k in ("background", "words") if k in automata]
            self.views.append((view, automata, grounds))
        self.kinds = self.views[0][1]
        self.known: dict[bytes, bool] = {}

    def score(self, value: str) -> tuple[float, str | None]:
        """Bits over the likelier background of the likeliest kind whose examples the value is like, and that kind."""
        best = (-math.inf, None)
        for view, kinds, grounds in self.views:
            seen = view(value)
            ground = max((g.bits(seen) for g in grounds), default=-(len(seen) + 1) * 4.0)
            for k, a in kinds.items():
                own = a.bits(seen)
                if own / (len(seen) + 1) >= a.typical:
                    best = max(best, (own - ground, k), key=lambda x: x[0])
        return best

    def takes(self, value: bytes) -> bool:
        """Whether the automata take a value for a credential; they see its classes alone, so values share answers."""
        look = value.translate(_CLASSES)
        if look not in self.known:
            if len(self.known) >= 200_000:
                self.known.clear()
            self.known[look] = self.score(value.decode())[0] >= self.min_bits
        return self.known[look]

    def spans(self, data: bytes, base: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        """The learned spans: candidates apart from the base spans that the automata take for credentials."""
        if not self.kinds:
            return []
        out = []
        for start, end, value in candidates(data):
            if self.takes(value):
                start = points(data, start)
                end = start + len(value)
                if not any(s < end and start < e for s, _, e, _ in base):
                    out.append((start, 3, end, start))
        return out


def examples(docs: DataFrame, sample: int = 1_000, longest: int = 512) -> dict[str, list[str]]:
    """Per kind, and of `background` and `words`, the `sample` distinct values of smallest hash over all documents."""

    def per_task(batches):
        least: dict[str, list] = {}
        inside: dict[str, set] = {}
        passed: set[str] = set()

        def offer(kind: str, value: str) -> None:
            if len(value) > longest or value in inside.setdefault(kind, set()) or kind == "words" and value in passed:
                return
            heap = least.setdefault(kind, [])
            item = (-int.from_bytes(hashlib.md5(value.encode()).digest()[:7]), value)
            if len(heap) < sample:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                inside[kind].discard(heapq.heapreplace(heap, item)[1])
            else:
                # Hashes that are left out once stay out; words are hashed again only when too many are kept.
                if kind == "words":
                    if len(passed) >= 200_000:
                        passed.clear()
                    passed.add(value)
                return
            inside[kind].add(value)

        for batch in batches:
            for data in text_bytes(batch.column("text")):
                base = base_spans(data)
                text = data.decode() if base else ""
                for _, kind, end, value in base:
                    offer(KINDS[kind], text[value:end])
                # Base spans in bytes, as the candidates are.
                inner = [(len(text[:s].encode()), len(text[:e].encode())) for s, _, e, _ in base]
                for start, end, value in candidates(data):
                    if not any(s < end and start < e for s, e in inner):
                        offer(background(value), value.decode())
        rows = [(k, -h, v) for k, heap in least.items() for h, v in heap]
        yield {"kind": [r[0] for r in rows], "hash": [r[1] for r in rows], "value": [r[2] for r in rows]}

    found = cut(map_arrow(docs, ["text"], per_task, "kind string, hash bigint, value string"))
    return {k: [r["value"] for r in found.where(F.col("kind") == k).distinct().orderBy("hash", "value").limit(sample).collect()] for k in (*KINDS[:3], "background", "words")}


def written(spans: list[tuple[int, int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in spans)


def scan(docs: DataFrame, formats: Formats | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(formats or Formats(examples(docs)))

    def per_task(batches):
        for batch in batches:
            out = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for data in text_bytes(batch.column("text")):
                base = base_spans(data)
                for k, name in enumerate(("n_assign", "n_access", "n_hex")):
                    out[name].append(sum(1 for b in base if b[1] == k))
                out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
                out["spans"].append(written(sorted(base + shared.value.spans(data, base))))
            yield out | {"doc_id": batch.column("doc_id")}

    return map_arrow(docs, ["doc_id", "text"], per_task, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def redacted(text: str, spans: list[tuple[int, int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with the values of the spans replaced; overlapping values become one mark."""
    out, at = [], 0
    for start, end in sorted((value, e) for _, _, e, value in spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, formats: Formats | None = None) -> DataFrame:
    """The documents, in their own columns, with secrets replaced; n_chars, where there is one, counts the new text of
    the documents that changed."""
    shared = docs.sparkSession.sparkContext.broadcast(formats or Formats(examples(docs)))
    schema: T.StructType = docs.schema
    text_at = schema.names.index("text")

    def per_task(batches):
        for batch in batches:
            texts, sizes = batch.column("text").to_pylist(), batch.column("n_chars").to_pylist() if "n_chars" in schema.names else None
            for i, data in enumerate(text_bytes(batch.column("text"))):
                base = base_spans(data)
                if spans := base + shared.value.spans(data, base):
                    texts[i] = redacted(texts[i], spans)
                    if sizes:
                        sizes[i] = len(texts[i])
            columns = [*batch.columns]
            columns[text_at] = pa.array(texts, type=batch.schema.field("text").type)
            if sizes:
                columns[schema.names.index("n_chars")] = pa.array(sizes, type=batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(per_task, schema)
