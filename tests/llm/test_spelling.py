"""Spelling variants and token counts against brute force, and their edges."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from qanvas.llm import spelling, token_counts
from qanvas.llm.common import Scratch
from qanvas.llm.queries import QUERIES

from ..conftest import SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_variants(rows, shortest=5, least=3, ratio=2, modulus=97):
    count = Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{w}".encode())
            count[w[: h % len(w)] + w[h % len(w) + 1 :] if h % modulus == 0 else w] += 1
    n = {w: c for w, c in count.items() if len(w) >= shortest and c >= least}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        short, long = sorted((a, b), key=len)
        return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    form, size = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        size[w], form[w] = len(others), best if best and n[best] >= ratio * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], size[w], n.get(form[w])) for w in n}


def variants(df, **kw):
    return [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in spelling.spelling_variants(df, **kw).collect()]


def test_spelling_edges(spark, awkward, empty):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    got = variants(awkward)
    assert len(got) == len(set(got)) and set(got) == brute_variants(rows)
    assert variants(empty) == []
    assert spelling.spelling_variants(empty).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_spelling_groups_by_brute_force(spark):
    """Words of a small alphabet: repeated letters (equal deletions), ties, chains of forms, the signs in the range."""
    rng = random.Random(5)
    texts = [(i if i % 7 else None, " ".join("".join(rng.choice("abÀ×") for _ in range(rng.randint(1, 8))) for _ in range(rng.randint(0, 120)))) for i in range(60)]
    texts += [(100 + i, f"{'house ' * 3**k}") for k, i in enumerate(range(2))] + [(200, "houses " * 30 + "housex " * 3 + "mouse " * 90 + "moose " * 200)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    for kw in ({}, {"shortest": 3, "least": 1, "modulus": 5}, {"shortest": 2, "least": 2, "ratio": 3}):
        got = variants(df, **kw)
        assert len(got) == len(set(got)) and set(got) == brute_variants(texts, **kw)


def test_roots_follow_long_paths(spark):
    forms = spark.createDataFrame([(f"w{i:03}", f"w{i + 1:03}") for i in range(37)] + [("x", "w010"), ("y", "z")], "word string, form string")
    got = {r["word"]: r["root"] for r in spelling.roots(forms, Scratch()).collect()}
    assert got == {f"w{i:03}": "w037" for i in range(37)} | {"x": "w037", "y": "z"}


def test_task_counts_are_passed_on_early(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TASK_WORDS", 3)
    df = spark.createDataFrame([(i, "alpha beta1 gamma delta epsilon") for i in range(9)], "doc_id long, text string")
    assert {r["word"]: r["n"] for r in spelling.word_counts(df, least=1, modulus=10**9).collect()} == dict.fromkeys(("alpha", "gamma", "delta", "epsilon"), 9)


@pytest.fixture(scope="module")
def shortcut():
    return token_counts.Shortcut(token_counts.default_model())


def test_token_counts_equal_the_library(spark, duck, shortcut):
    want = {i: (len((t or "").encode()), len(shortcut.model.encode(t or ""))) for i, t in duck.sql("SELECT doc_id, text FROM documents").fetchall()}
    rows = QUERIES["op12_token_counts"](spark, SF).collect()
    assert len(rows) == len(want)
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in rows} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in rows)


def test_token_count_edges(awkward, empty, shortcut):
    rows = token_counts.token_counts(awkward).collect()
    texts = Counter((r["doc_id"], len((r["text"] or "").encode()), len(shortcut.model.encode(r["text"] or ""))) for r in awkward.collect())
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in rows) == texts
    assert token_counts.token_counts(empty).count() == 0
    assert {r["over_limit"] for r in token_counts.token_counts(awkward, limit=0).where("n_tokens > 0").collect()} == {True}


PIECES = ["a", "the", "ing", " ", "  ", "▁", "\n", "\t", "\x00", "é", "é", "漢", "字", "🙂", "<s>", "</s>", "<unk>", "<0x0A>", "ﬁ", "Ａ", ".", ",", "...", "12", "ß"]


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.lists(st.sampled_from(PIECES), max_size=30).map("".join), st.text(max_size=40)))
def test_any_text_counts_as_the_library_has_it(text):
    known = token_counts.shortcut(token_counts.default_model())
    text = text.encode("utf-8", "ignore").decode()
    assert known.count([text]) == [len(known.model.encode(text))]


def test_whole_tokens_need_no_merging_and_the_cache_is_bounded(shortcut):
    small = token_counts.Shortcut(token_counts.default_model(), cache_bytes=2_000)
    assert small.whole == shortcut.whole and len(small.whole) > 30_000
    assert small.count(["the house is over there"]) == [5] and small.merged == 0
    texts = [" ".join(f"w{i * j}zq" for j in range(20)) for i in range(50)]
    assert [n for t in texts for n in small.count([t])] == [len(x) for x in small.model.encode(texts)]
    assert len(small.known) < len(small.proved) + 60
