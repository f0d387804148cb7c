"""Queries with SQL, and checks of the others against brute force on the small tables."""

import hashlib
import html
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from qanvas.llm.oracles import ORACLES
from qanvas.llm.queries import QUERIES

from ..conftest import SF
from ..helpers import same

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def documents(duck):
    return dict(duck.sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


def held(doc_id, modulus, value):
    return zlib.crc32(str(doc_id).encode()) % modulus == value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    same(QUERIES[name](spark, SF), duck.sql(ORACLES[name]))


def test_language_model_counts_and_beats_the_base(spark, documents):
    got = {r["doc_id"]: r for r in QUERIES["op2_language_model"](spark, SF).collect()}
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOWER)), ""] for i, t in documents.items()}
    c = Counter(w for i, t in tokens.items() if not held(i, 7, 2) for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in tokens.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(t), sum(c[w] > 0 for w in t), n, held(i, 7, 2))
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
        assert r["score"] < 0


def test_packing_is_an_exact_round_trip_with_little_padding(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in QUERIES["op3_packing"](spark, SF).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for i, text in documents.items():
        ids = [*encode(text, add_special_tokens=False).ids, 2]
        at = 0
        for p in sorted(pieces[i], key=lambda p: p["start"]):
            own = ids[p["start"] : p["start"] + p["length"]]
            assert (p["start"], p["doc_tokens"], len(own)) == (at, len(ids), p["length"])
            assert p["ids_crc32"] == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in own))
            at += p["length"]
        assert at == len(ids)
    padding = 0
    for parts in sequences.values():
        parts.sort(key=lambda p: p["offset"])
        total = 0
        for p in parts:
            assert p["offset"] == total
            total += p["length"]
        assert total <= 4096
        padding += 4096 - total if total & (total - 1) else 0
    assert padding < 0.02 * 4096 * len(sequences)
    # Differencing's windows stay: a document that fits one is cut only in a task's last remainder.
    cut = [i for i, p in pieces.items() if len(p) > 1 and p[0]["doc_tokens"] <= 4096]
    assert len(cut) <= 0.02 * len(pieces)


def test_secrets_base_spans_by_brute_force(spark, documents):
    patterns = {
        "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
        "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    }
    for r in QUERIES["op5_secrets"](spark, SF).collect():
        found = sorted((m.start(), k, name, m.end()) for k, (name, (p, ok)) in enumerate(patterns.items()) for m in p.finditer(documents[r["doc_id"]]) if ok(m))
        text = ",".join(f"{name}:{s}:{e}" for s, _, name, e in found)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(f[2] == n for f in found) for n in patterns]
        assert set(filter(None, text.split(","))) <= set(r["spans"].split(","))


def test_main_text_is_the_article(spark, duck):
    pages = dict(duck.sql("SELECT page_id, html FROM pages").fetchall())
    for r in QUERIES["op8_main_text"](spark, SF).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        wanted = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?p>|<br>|</?h1>", inner)]
        assert r["text"] == "\n".join(filter(None, wanted))
        assert r["n_chars"] == len(r["text"])


def shingles(text):
    w = WORD.findall(text.translate(LOWER))
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter({("raw", text): 1})


def test_near_duplicate_classes_by_brute_force(spark, documents):
    sets = {i: shingles(t) for i, t in documents.items()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and 10 * (sets[a] & sets[b]).total() >= 8 * (sets[a] | sets[b]).total():
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op9_near_duplicates"](spark, SF).collect()}
    assert got == {i: root(i) for i in ids}


@pytest.mark.parametrize(("name", "modulus", "value", "label", "least"), [("op4_quality", 4, 2, "quality", 0.85), ("op6_toxicity", 5, 0, "toxic", 0.95)])
def test_held_out_accuracy(spark, duck, name, modulus, value, label, least):
    sf = SF.replace("sf0.001", "sf0.01")
    y = dict(duck.sql(f"SELECT doc_id, {label} FROM '{sf}/labels.parquet'").fetchall())
    rows = QUERIES[name](spark, sf).collect()
    assert all(r["held_out"] == held(r["doc_id"], modulus, value) and 0 <= r["score"] <= 1 for r in rows)
    tested = [r["predicted"] == y[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in y]
    assert sum(tested) >= least * len(tested)
    if label == "toxic":
        found = [r["predicted"] for r in rows if r["held_out"] and y.get(r["doc_id"]) == 1]
        assert sum(found) >= 0.6 * len(found)
        assert len({r["score"] for r in rows}) > 0.5 * len(rows)


def test_pipeline_follows_its_stages(spark, documents, duck):
    """Stage by stage: each keeps the columns, works on what the one before kept, and leaves what it should."""
    import corpus_pipeline as P
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = P.STAGES[0][1](spark, docs, SF)
    kept = {r["doc_id"] for r in QUERIES["op4_quality"](spark, SF).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in good.collect()} == kept
    single = P.STAGES[1][1](spark, good, SF)
    assert single.columns == docs.columns
    left = {r["doc_id"] for r in single.collect()}
    assert left <= kept
    clean = P.STAGES[2][1](spark, single, SF)
    bad = {r[0] for r in duck.sql(f"SELECT doc_id FROM ({ORACLES['op7_decontamination']}) WHERE contaminated").fetchall()}
    assert {r["doc_id"] for r in clean.collect()} == left - bad
    safe = P.STAGES[3][1](spark, clean, SF)
    assert safe.where(F.col("text").rlike(r"(?i)token = \"[0-9a-f]{20}")).count() == 0
    assert safe.count() == clean.count()
    assert P.STAGES[4][1](spark, safe, SF).select("doc_id").distinct().count() == safe.count()
