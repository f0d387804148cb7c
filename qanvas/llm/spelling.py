"""Spelling variants of a corpus's words, grouped without a pair of words ever being made.

Two words are near if they differ by exactly one inserted, deleted or replaced code point; a word's form is its near word
of largest count (ties: the smallest in code-point order), if that count is at least `ratio` times the word's own.

Plan:
1. Words. One pass over whole texts; a task adds up its own counts before they are shuffled, so a frequent word moves
   once a task and lot, not once an occurrence.
2. Replacements. A word of n code points is in n groups (position, prefix, suffix): the word with one position wild. A
   group holds as many words as there are letters at most, whatever the corpus (some 90 here). It keeps its size and its
   top two words; a member sees size - 1 near words there, of which the best is the first, or, for the first, the second.
3. Insertions and deletions. Each distinct string that a word leaves when one code point goes is joined with the
   vocabulary by equality. The match is a near word of the longer word (at most n of them) and, added up by the shorter
   one (count and best), the longer words are near words of the shorter.
4. A near word is met exactly once in 2 and 3: words of equal length differ in one position, and equal deletions of a word
   (from a run of one letter) are one string. So sizes add up to n_near and the best of the bests is the form.
5. Roots. A form has at least `ratio` (2 or more) times the count, so a path is as long as the logarithm of the largest
   count; paths are followed by doubling, and each step is written to the shared folder.

Defined cases: null text has no words; a null id is the text `null` in the hash that alters words; repeated rows count
again; the signs U+00D7 and U+00F7 lie in the range and are letters here, as stated; words lose no accents; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, map_arrow

#: Latin-1 bytes of a text to words: A-Z is lowered, a-z and U+00C0 to U+00FF stay, all else (`?` for what Latin-1 lacks) parts words.
LETTERS = bytes(b + 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))
#: Distinct words that a task adds up before it passes their counts on.
TASK_WORDS = 200_000


def runs(text: str) -> list[bytes]:
    """The lowered maximal runs of letters, in Latin-1."""
    return text.encode("latin-1", "replace").translate(LETTERS).split()


def altered(word: bytes, start: int, modulus: int) -> bytes:
    """The word, or, where `modulus` divides the checksum of the id (`start`) and the word, without one code point."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
    if h % modulus:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, shortest: int = 5, least: int = 3, modulus: int = 97) -> DataFrame:
    """word, n of all words of `shortest` code points or more that occur `least` times or more."""

    def per_task(batches):
        total: dict[bytes, int] = defaultdict(int)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                start = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(runs(text.as_py() or "")).items():
                    if len(word) >= shortest and len(word := altered(word, start, modulus)) >= shortest:
                        total[word] += n
                if len(total) > TASK_WORDS:
                    yield _counted(total)
                    total.clear()
        yield _counted(total)

    part = map_arrow(docs, ["doc_id", "text"], per_task, "word string, n bigint")
    return part.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _counted(total: dict[bytes, int]) -> dict:
    return {"word": [w.decode("latin-1") for w in total], "n": pa.array(total.values(), pa.int64())}


def _rank(n: str = "n", word: str = "word") -> Column:
    """What sorts words by falling count, then by code points (Spark compares strings by their UTF-8 bytes, which is the same)."""
    return F.struct((-F.col(n)).alias("less"), F.col(word).alias("word"))


def _positions() -> Column:
    return F.sequence(F.lit(1), F.length("word"))


def replacements(words: DataFrame) -> DataFrame:
    """word, near (how many words differ by a replacement at one position), best (struct less, word)."""
    wild = F.transform(_positions(), lambda i: F.overlay("word", F.lit("*"), i))
    groups = words.select("word", _rank().alias("rank"), F.explode(wild).alias("wild"))
    of, top = Window.partitionBy("wild"), Window.partitionBy("wild").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = groups.select("word", "rank", F.count("*").over(of).alias("size"), F.first("rank").over(top).alias("first"), F.nth_value("rank", 2).over(top).alias("second"))
    best = F.when(F.col("rank") == F.col("first"), F.col("second")).otherwise(F.col("first"))
    return seen.where("size > 1").select("word", (F.col("size") - 1).alias("near"), best.alias("best"))


def indels(words: DataFrame, shortest: int) -> DataFrame:
    """word, near, best of the near words that are one code point shorter or longer, a row per match for the longer word
    and a row per word for the shorter."""
    cut = F.array_distinct(F.transform(_positions(), lambda i: F.overlay("word", F.lit(""), i, F.lit(1))))
    longer = words.where(F.length("word") > shortest).select(F.col("word").alias("long"), _rank().alias("by_long"), F.explode(cut).alias("word"))
    met = longer.join(words.select("word", _rank().alias("by_short")), "word")
    one = F.struct(F.col("long").alias("word"), F.lit(1).cast("long").alias("near"), F.col("by_short").alias("best"))
    other = F.struct(F.col("word").alias("word"), F.lit(1).cast("long").alias("near"), F.col("by_long").alias("best"))
    return met.select(F.explode(F.array(one, other)).alias("x")).select("x.*")


def spelling_variants(docs: DataFrame, shortest: int = 5, least: int = 3, ratio: int = 2, modulus: int = 97) -> DataFrame:
    """word, form, root, n, n_near, form_n: a row per word."""
    scratch = Scratch()
    words = scratch.cut(word_counts(docs, shortest, least, modulus))
    near = replacements(words).unionByName(indels(words, shortest)).groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    has = -F.col("best.less") >= ratio * F.col("n")
    found = words.join(near, "word", "left").select(
        "word", F.when(has, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, -F.col("best.less")).alias("form_n")
    )
    found = scratch.cut(found)
    ends = roots(found.where("form IS NOT NULL").select("word", "form"), scratch)
    out = found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    scratch.drop(words)
    return out


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """word, root of forms (word, form) without cycles: each step doubles the way that every word has followed."""
    step = scratch.cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = step.select(F.col("word").alias("root"), F.col("root").alias("then"))
        met = scratch.cut(step.join(further, "root", "left").select("word", F.coalesce("then", "root").alias("root"), F.col("then").isNotNull().alias("moved")))
        scratch.drop(step)
        if met.where("moved").isEmpty():
            return met.select("word", "root")
        step = met
