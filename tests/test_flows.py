"""The multiple-choice flows: fallbacks by small cases, the cloze test against brute force."""

import hashlib
import re

from qanvas.operators import flows as W
from qanvas.plans.registry import QUERIES

from .conftest import SF


def test_distractors_and_their_fallbacks(spark):
    rows = [
        (1, "cat", "1. dog\n2. Cow\n3. Cat\n4. hen", ["cat", "DOG", "ox"], None),
        (2, "cat", "1. dog", [], "CAT, emu , asp, ,yak, owl"),
        (3, "cat", "1. dog", ["ox"], "Cat"),
        (4, "cat", None, None, None),
        (5, "cat", "", [], ""),
    ]
    asked = spark.createDataFrame(rows, "qid long, answer string, completion string, existing array<string>, fallback string")
    got = {r["qid"]: (r["pool"], r["distractors"], sorted(r["options"])) for r in W.finished(W.distractors(asked)).collect()}
    assert got == {
        1: (["dog", "Cow", "hen", "ox"], ["dog", "Cow", "hen"], ["Cow", "cat", "dog", "hen"]),
        2: (["dog"], ["emu", "asp", "yak"], ["asp", "cat", "emu", "yak"]),
        3: (["dog", "ox"], ["dog", "ox"], ["cat", "dog", "ox"]),
        4: ([], [], ["", "", "", "cat"]),
        5: ([], [], ["", "", "", "cat"]),
    }
    assert W.distractors(asked.limit(0)).count() == 0


def test_cloze_test_by_brute_force(spark, duck):
    hashed = lambda *x: int(hashlib.md5("|".join(map(str, x)).encode()).hexdigest()[:8], 16)
    got = {r["id"]: (r["cloze"], list(zip(r["positions"], r["options"], r["letters"], strict=True))) for r in QUERIES["cloze_test"](spark, SF).collect()}
    want, punctuation = {}, re.compile(r"[!\"#$%&()*+,./:;<=>?@\[\\\]^_`{|}~0-9]")
    for i, text in duck.sql("SELECT item_id, text FROM benchmark WHERE text IS NOT NULL").fetchall():
        w = text.split()
        ranked = sorted((-(hashed("blank", i, p) % 1000) / 1000.0, p) for p, x in enumerate(w) if x.lower() not in ("a", "an") and not x[0].isupper() and not punctuation.search(x))
        blanks, used = [], set()
        for _, p in ranked:
            if len(blanks) < 3 and w[p] not in used and all(abs(p - q) >= 4 for q in blanks):
                blanks.append(p)
            used.add(w[p])
        out = []
        for p in sorted(blanks):
            at = hashed("slot", f"{i}:{p}") % 4
            options = [w[(p + k) % len(w)] for k in (1, 2, 3)]
            out.append((p, [*options[:at], w[p], *options[at:]], "ABCD"[at]))
        if w:
            want[i] = (" ".join("_" if p in blanks else x for p, x in enumerate(w)), out)
    assert got == want and any(b for _, b in want.values())


def test_pages_of_large_and_broken_files(spark, tmp_path):
    """A file in many ranges, empty pages, a page that is no UTF-8, a file without a form feed."""
    from qanvas.sources import books as B

    pages = [f"page {i} é " + "x" * (i * 37 % 900) if i % 5 else " \n" for i in range(1, 400)]
    (tmp_path / "a.txt").write_bytes("\f".join(pages).encode())
    (tmp_path / "b.txt").write_bytes(b"good\fbad \xff\xfe\f\flast\nline")
    (tmp_path / "c.txt").write_bytes(b"only")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = B.text_pages(spark, str(tmp_path))
        got = {(r["path"][-5:], r["page"]): (r["text"], r["error"]) for r in df.collect()}
        assert df.rdd.getNumPartitions() > 0 and spark.read.option("lineSep", "\f").text(str(tmp_path)).rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    want = {("a.txt", i): (p, None) for i, p in enumerate(pages, 1) if p.strip()}
    assert got == want | {("b.txt", 1): ("good", None), ("b.txt", 2): (None, "not UTF-8"), ("b.txt", 4): ("last\nline", None), ("c.txt", 1): ("only", None)}
