"""Token counts of a sentencepiece BPE vocabulary by the whole-token shortcut: most words need no merging at all.

Proved offline, once a worker, from the vocabulary itself (`Shortcut`):
1. No piece holds a word mark (U+2581, which stands for a space) behind another character, so no merge crosses the place
   before a mark: a text is cut there into pre-tokens, and its count is the sum of theirs.
2. A character of no piece of two or more characters never merges: it is cut off as well and counts for itself (one
   token if it is a piece, else one for each byte).
3. Which pieces come out as one token when the library encodes them alone: a pre-token that is such a piece counts 1.
Only pre-tokens left over are merged, by the library, each distinct one once; their counts are kept in a cache that is
bounded in bytes. There is no shuffle, and a task holds one lot of texts at a time.

Defined cases: null text is empty; an empty text has no tokens; strings such as `<s>` or `<0x0A>` inside a text are text;
a mark inside a text is a space; leading, trailing and repeated spaces count as the library has them; repeated rows and
null ids get a row each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re

import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lots, map_arrow

MARK = "▁"
LOT_BYTES = 2_000_000
_PROBE = "Ａﬁ ①  éé "


class Shortcut:
    """A vocabulary with what is proved about it. count(texts) gives the library's number of tokens of each text."""

    def __init__(self, model_path: str, cache_bytes: int = 64_000_000) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        m = self.model
        if m.normalize(_PROBE) != MARK + _PROBE.replace(" ", MARK):
            raise ValueError("texts must reach the model as they are, with a mark in front and for every space")
        plain = [m.id_to_piece(i) for i in range(m.get_piece_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        if any(MARK in p.lstrip(MARK) for p in plain):
            raise ValueError("a piece holds a mark behind another character: pre-tokens aren't independent")
        merging = {c for p in plain if len(p) > 1 for c in p}
        #: A character that never merges and is no piece: what follows it is encoded as if it stood alone, without a mark in front.
        self.fence = next(c for c in map(chr, range(128)) if c not in merging and c not in plain)
        self.fence_tokens = len(m.encode(self.fence))
        self.singles = {p for p in plain if len(p) == 1 and p not in merging}
        escaped = "".join(map(re.escape, sorted(merging)))
        self.runs = re.compile(f"[{escaped}]+")
        self.others = re.compile(f"[^{escaped}]")
        alone = [len(x) - self.fence_tokens == 1 for x in m.encode([self.fence + p for p in plain], num_threads=1)]
        self.whole = frozenset(p for p, one in zip(plain, alone, strict=True) if one)
        #: Counts of words that follow one space: the pieces that are whole, later also what was merged.
        self.known = {p[1:]: 1 for p in self.whole if p[0] == MARK and p[1:] and MARK not in p[1:]}
        self.proved = frozenset(self.known)
        self.room, self.cache_bytes = cache_bytes, cache_bytes
        self.merged = 0

    def _merge(self, words: set[str]) -> dict[str, int]:
        """Counts of words that follow one space, those that aren't known yet."""
        counts, rest, parts = dict.fromkeys(words, 0), [], []
        for w in words:
            counts[w] = sum(1 if c in self.singles else len(c.encode()) for c in self.others.findall(w))
            for run in self.runs.findall(MARK + w):
                if run in self.whole:
                    counts[w] += 1
                else:
                    rest.append(run)
                    parts.append(w)
        self.merged += len(rest)
        for w, ids in zip(parts, self.model.encode([self.fence + r for r in rest], num_threads=1) if rest else [], strict=True):
            counts[w] += len(ids) - self.fence_tokens
        return counts

    def count(self, texts: list[str]) -> list[int]:
        split = []
        for text in texts:
            words = text.replace(MARK, " ").split(" ") if text else []
            if "" in words:  # Further spaces stay with the word that they precede.
                words = [p[1:] for p in re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK))]
            split.append(words)
        new = set().union(*split).difference(self.known)
        if new:
            counts = self._merge(new)
            self.room -= sum(map(len, new)) * 2 + 150 * len(new)
            if self.room < 0:
                # Only what this lot needs stays beside the proved pieces.
                needed = set().union(*split).intersection(self.known)
                self.known = dict.fromkeys(self.proved, 1) | {w: self.known[w] for w in needed}
                self.room = self.cache_bytes
            self.known.update(counts)
        get = self.known.__getitem__
        return [sum(map(get, words)) for words in split]


_loaded: dict[str, Shortcut] = {}


def shortcut(model_path: str) -> Shortcut:
    """Loaded and proved once a worker process."""
    if model_path not in _loaded:
        _loaded[model_path] = Shortcut(model_path)
    return _loaded[model_path]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def token_counts(docs: DataFrame, model_path: str | None = None, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit of every row. Executors read the model at `model_path`."""
    path = model_path or default_model()

    def per_task(batches):
        known = shortcut(path)
        for batch in batches:
            for lot in lots(batch, LOT_BYTES):
                text = pc.fill_null(lot.column("text"), "")
                yield {"doc_id": lot.column("doc_id"), "n_bytes": pc.binary_length(text), "n_tokens": known.count(text.to_pylist())}

    counted = map_arrow(docs, ["doc_id", "text"], per_task, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
