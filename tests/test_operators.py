"""Operators: properties and small cases."""

import json
import re
from collections import Counter
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from qanvas.functions import lexicons as L
from qanvas.operators import choices as C
from qanvas.operators import questions as Q
from qanvas.plans.registry import QUERIES
from qanvas.plans.vector_queries import arrivals_of, scored
from qanvas.sources import books as B
from qanvas.sources import sinks as S

from .conftest import SF


def test_append_twice_is_append_once(spark):
    new = spark.createDataFrame([("a", 1), ("b", None), ("a", 1)], "x string, y int")
    old = spark.createDataFrame([("a", 1)], "x string, y int")
    once = S.dedup_append(new, old)
    assert sorted(once.collect()) == sorted(S.dedup_append(new, once).collect())
    assert once.count() == 2


def test_chunks_are_full_but_the_last(spark):
    rows = spark.range(0, 1_234)
    sizes = sorted(r["count"] for r in S.chunked(rows, ["id"], 50).groupBy("chunk").count().collect())
    assert sizes == [34] + [50] * 24
    assert S.chunked(spark.range(0), ["id"]).count() == 0


def test_manifest_types(spark):
    rows = S.manifest_rows(spark.createDataFrame([("multi_hop_inverse", "1"), ("short", "2"), ("tf", "3")], "type string, isbn string"))
    assert {(r["file_name"], r["type"]) for r in rows.collect()} == {("multi_hop_inverse_QA-1.json", "multi"), ("short_QA-2.json", "short"), ("TF_QA-3.json", "tf")}


def test_balance_never_lets_a_category_lag_further(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    got = Q.balanced(arrivals_of(events), ["scope"], ["event_id"])
    for r in got.groupBy("scope").agg(F.collect_list("assigned").alias("a")).collect():
        counts = Counter(L.CATEGORY[t] for t in r["a"])
        assert sum(counts.values()) == len(r["a"])
        assert max(counts.values()) - min(counts.get(c, 0) for c in L.CATEGORIES) <= 10


def test_suffix_map_and_repair(spark):
    items = spark.createDataFrame([(1, ["spirin", "aspirin", "ASPIRIN ", "statin"], "spirin")], "qid long, options array<string>, answer string")
    got = C.repaired(items).first()
    assert (got["options"], got["answer"]) == (["Aspirin", "Statin"], "Aspirin")
    empty = spark.createDataFrame([(2, [], "x")], "qid long, options array<string>, answer string")
    assert C.repaired(empty).first()["options"] == []


def test_selection_is_k_distinct_and_exact_is_best(spark):
    rows = scored(spark, SF)
    for exact in (False, True):
        picks = C.select_candidates(rows.where("i < 60"), k=3, exact=exact).groupBy("qid").agg(F.collect_set("i").alias("i"), F.count("*").alias("n")).collect()
        assert picks
        assert all(len(r["i"]) == r["n"] <= 3 for r in picks)


def test_exact_select_is_the_best_of_the_whole_pool(spark):
    """Against all subsets, with zero similarities, repeated vectors and ties; and no annealed choice is better."""
    rng = np.random.default_rng(5)
    for k, m, spread in ((1, 9, 1.0), (2, 15, 0.1), (3, 24, 1.0), (3, 24, 0.05), (4, 13, 0.3)):
        x = rng.normal(size=(m + 1, 6))
        x[1] = x[0]
        distance = 1 - (x @ x.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1))
        distance = np.where(distance < 1e-12, 0.0, distance)
        ctx, sim = np.round(rng.random(m) * spread, 1 + (spread < 1)), np.maximum(0, np.round(rng.random(m), 1) - 0.1 * (k % 2))
        want = max(combinations(range(m), k), key=lambda s: (round(C._objective(s, ctx, distance, sim, 0.3, 0.4), 12), tuple(-i for i in s)))
        assert C._best(k, ctx, distance, sim, 0.3, 0.4) == want
    rows = QUERIES["exact_select"](spark, SF), QUERIES["anneal_select"](spark, SF)
    energy = [{r["qid"]: r["objective"] for r in C.energy(scored(spark, SF, False).join(r, ["qid", "i"])).collect()} for r in rows]
    assert energy[0].keys() == energy[1].keys() and len(energy[0]) > 1
    assert all(energy[0][q] >= energy[1][q] - 1e-9 for q in energy[0])


def test_suffix_repair_and_close_match_take_all_words(spark, duck):
    texts = [t for (t,) in duck.sql("SELECT text FROM benchmark").fetchall()]
    words = {re.sub("[^a-z]", "", w.lower()) for t in texts for w in t.split()} - {""}
    longer = {w: max((x for x in words if x.endswith(w) and 1 <= len(x) - len(w) <= 2), default=None) for w in words}
    got = {r["text"]: r["longer"] for r in QUERIES["suffix_repair_words"](spark, SF).collect()}
    assert got == {w: x for w, x in longer.items() if x}
    assert len(got) < QUERIES["suffix_repair"](spark, SF).count()  # that one has the documents' words as well

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, was = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(was[j] + 1, row[-1] + 1, was[j - 1] + (x != y)))
        return row[-1]

    near = {w: min(((edits(w, x), x) for x in words if x != w and abs(len(x) - len(w)) <= 2), default=(3, None)) for w in words}
    got = {r["text"]: r["match"] for r in QUERIES["close_match_words"](spark, SF).collect()}
    assert got == {w: x for w, (d, x) in near.items() if d <= 2}


def test_fallback_words_draw_from_the_whole_lexicon(spark):
    lexicon = spark.range(3_000).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("word"))
    answers = spark.range(2_000).select(F.col("id").alias("qid"), F.lit("none").alias("answer"))
    got = {r["qid"]: r["w"] for r in C.fallback_words(lexicon, answers, 3).groupBy("qid").agg(F.collect_list("word").alias("w")).collect()}
    assert len(got) == 2_000 and all(len(set(w)) == len(w) == 6 for w in got.values())
    assert len({x for w in got.values() for x in w}) > 2_800
    few = C.fallback_words(lexicon.limit(4), spark.createDataFrame([(1, "W0")], "qid long, answer string"), 3)
    assert sorted(r["word"] for r in few.collect()) == ["W1", "W2", "W3"]
    assert C.fallback_words(lexicon.limit(0), answers, 3).count() == 0


def test_energy_counts_the_distances_to_the_answer(spark):
    rows = [(1, 1, 0.5, 1.0, [1.0, 0.0], [0.0, 1.0]), (1, 2, 0.25, 1.0, [1.0, 1.0], [0.0, 1.0])]
    selected = spark.createDataFrame(rows, "qid long, i long, ctx double, sim double, embedding array<double>, answer array<double>")
    near = 1 - 0.5**0.5
    got = C.energy(selected).first()
    assert abs(got["e_emb"] - 3 / (1 / near + 1 / 1 + 1 / near)) < 1e-9
    assert abs(got["objective"] - (0.75 + 0.3 * got["e_emb"] - 0.4)) < 1e-9


def test_selection_prefers_what_is_far_from_the_answer_and_leaves_it_out(spark):
    rows = [(1, i, 0.5, 0.5, x, [1.0, 0.0]) for i, x in enumerate([[1.0, 0.1], [0.1, 1.0], [-1.0, 0.1]])]
    selected = C.select_candidates(spark.createDataFrame(rows, "qid long, i long, ctx double, sim double, embedding array<double>, answer array<double>"), k=1, exact=True)
    assert [r["i"] for r in selected.collect()] == [2]
    answers = {(r["qid"], r["i"]) for r in scored(spark, SF).groupBy("qid").agg(F.min("i").alias("i")).collect()}
    for name in ("exact_select", "anneal_select"):
        assert not answers & {(r["qid"], r["i"]) for r in QUERIES[name](spark, SF).collect()}


def test_greedy_blanks_keep_their_distance(spark):
    rows = spark.createDataFrame([(1, p, s) for p, s in enumerate([0.1, 0.9, 0.8, 0.2, 0.3, 0.7])], "id long, position int, score double")
    assert [r["position"] for r in C.greedy_blanks(rows, count=3, spacing=3).orderBy("position").collect()] == [1, 5]


def test_context_window_grows_to_the_least_words(spark):
    s = F.array(*map(F.lit, ["a b", "c d", "e f", "g h"]))
    got = spark.range(1).select(C.context_window(s, F.lit(1), 5).alias("w"), C.context_window(s, F.lit(3), 3).alias("v")).first()
    assert (got["w"], got["v"]) == ("a b c d e f", "e f g h")


def test_books_skip_files_that_are_not_json(spark, tmp_path):
    book = {"ISBN": "1", "Title": "T", "Paragraphs": [{"Paragraph ID": "1-p1-para1", "Section": "1-p1", "Page": 1, "Text": "x"}]}
    (tmp_path / "1_processed.json").write_text(json.dumps(book, indent=4))
    (tmp_path / "2_processed.json").write_text("{")
    rows = B.book_paragraphs(B.books(spark, str(tmp_path)))
    assert [(r["isbn"], r["page"], r["text"]) for r in rows.collect()] == [("1", 1, "x")]


def test_catalog_defaults_and_pages(spark, tmp_path):
    (tmp_path / "data.csv").write_text("Title,ISBN-10,ISBN-13,File Link\nT,,9,a.pdf\n,,8,\n")
    rows = B.catalog(spark, str(tmp_path / "data.csv"))
    assert {r["title"] for r in rows.collect()} == {"T", "Unknown Title"}
    files = spark.createDataFrame([("a.pdf", bytearray(b"one\fb"))], "path string, content binary")
    assert B.valid_rows(rows, files).count() == 1
    assert [r["text"] for r in B.pages_of_files(files, lambda b: b.decode().split("\f")).orderBy("page").collect()] == ["one", "b"]
    assert B.pages_of_files(files, lambda b: 1 / 0).first()["error"]


def test_saved_arrays_and_corrupt_files(spark):
    from pyspark.sql import types as T

    from qanvas.session import shared_folder
    from qanvas.sources import books

    folder = shared_folder(spark, "arrays")
    books.write_text(spark, f"{folder}/a.json", '[{"question": "q1"}, {"question": "q2", "more": 1}]')
    books.write_text(spark, f"{folder}/b.json", "{broken")
    schema = T.StructType([T.StructField("question", T.StringType())])
    assert sorted(r["question"] for r in books.saved_questions(spark, folder, schema, arrays=True).collect()) == ["q1", "q2"]
    assert books.saved_questions(spark, f"{folder}-none", schema).count() == 0


def test_sentence_variances_by_brute_force(spark):
    import numpy as np

    from qanvas.operators.questions import sentence_variances

    rows = [("a", [1.0, 2.0]), ("a", [3.0]), ("a", [4.0, 5.0, 9.0]), ("b", [7.0])]
    got = {r["k"]: r for r in sentence_variances(spark.createDataFrame(rows, "k string, v array<double>"), "k").collect()}
    padded = np.array([[1, 2, 0], [3, 0, 0], [4, 5, 9]], dtype=float)
    assert np.isclose(got["a"]["coherence"], padded.var(ddof=1)) and np.isclose(got["a"]["entropy"], np.var([1.5, 3, 6]))
    assert got["b"]["coherence"] is None and got["b"]["entropy"] == 0
