"""Cases of the third round's findings."""

import shutil
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from qanvas.operators import choices as C
from qanvas.operators import flows as W
from qanvas.operators import generation as G
from qanvas.operators import masked as M
from qanvas.operators import questions as Q
from qanvas.plans.registry import ORACLES, QUERIES
from qanvas.streaming.incremental import append_batches

from .conftest import SF


def test_fallbacks_of_answers_with_commas(spark):
    rows = [("Aningor,", "ANINGOR,, alpha,beta , gamma,delta"), ("red, (big)", "blue, RED, (BIG) ,red,(BIG), green"), (r"a\E,b", r"A\e,B,c"), ("cat", "CAT, emu"), ("x,", None)]
    asked = spark.createDataFrame(rows, "answer string, fallback string")
    got = [r["parts"] for r in asked.select(W.comma_fallback("fallback", "answer").alias("parts")).collect()]
    assert got == [["alpha", "beta", "gamma"], ["blue", "red", "(BIG)"], ["c"], ["emu"], []]


def test_first_type_by_edges_of_ascii(spark, duck):
    words = " ".join(["wa"] * 14)
    texts = ["éAnn Lee says", "say Ann Leeé", "Xé1234é", "a_1234", "1234", "Ann Lee_", "ſelect one", "ſalt", f"x,\v{words}\v", f"x, {words} end", "12/3/2024ß"]
    sql = ORACLES["type_v1"].replace("FROM documents", "FROM typed_texts ORDER BY doc_id")
    shown = "(VALUES " + ", ".join(f"({i}, '{t}')" for i, t in enumerate(texts)) + ") AS v(doc_id, text)"
    want = [r[1] for r in duck.sql(sql.replace("typed_texts", shown)).fetchall()]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = [r["t"] for r in rows.select("i", Q.first_type("text").alias("t")).orderBy("i").collect()]
    assert got == want
    assert got[:2] == ["short", "short"]


def test_source_struct_has_sections(spark):
    got = {(r["section"] == "Unknown Section") == (r["doc_id"] % 4 == 0) for r in QUERIES["source_struct"](spark, SF).select("doc_id", "section").collect()}
    assert got == {True}
    assert QUERIES["source_struct"](spark, SF).where(F.col("section").isNull()).count() == 0


def test_best_sets_of_pools_without_their_pairs():
    rng = np.random.default_rng(3)
    for m, d, kind in [(30, 4, "plain"), (30, 4, "copies"), (28, 3, "zeros"), (40, 5, "ties")] * 3:
        x = rng.normal(size=(m + 1, d))
        if kind == "copies":
            x[rng.integers(m, size=m // 2)] = x[0]
        if kind == "zeros":
            x[rng.integers(m, size=3)] = 0
        ctx = np.round(rng.random(m), 1) if kind == "ties" else rng.random(m)
        apart = C._Apart(x)
        cos = 1 - apart.row(m, slice(0, m))
        sim = (cos - cos.min()) / (cos.max() - cos.min())
        for k in (1, 2, 3):
            assert C._best_apart(k, ctx, x, sim, 0.3, 0.4) == C._best(k, ctx, apart.among([*range(m + 1)]), sim, 0.3, 0.4)
    # The distances of all pairs of this pool alone are 13 GB.
    x = rng.normal(size=(40_001, 8))
    cos = 1 - C._Apart(x).row(40_000, slice(0, 40_000))
    tracemalloc.start()
    assert len(C._best_apart(2, rng.random(40_000), x, (cos - cos.min()) / (cos.max() - cos.min()), 0.3, 0.4)) == 2
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6


def test_appends_hash_a_record_once(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    rows = spark.createDataFrame([("a", "x"), ("a", "x"), (None, "x"), ("b", None)], "text string, lang string")
    more = spark.createDataFrame([("a", "x"), ("c", "y")], "text string, lang string")
    write = append_batches(out, rows.schema)
    for batch in (rows, more, rows, more):
        write(batch, 0)
    assert sorted(map(repr, spark.read.schema(rows.schema).parquet(out).collect())) == sorted(map(repr, rows.unionByName(more).distinct().collect()))
    assert spark.read.parquet(f"{out}/_digests").count() == 4
    shutil.rmtree(tmp_path / "out" / "_digests")  # an index that was lost is made anew
    write(more, 0)
    assert spark.read.schema(rows.schema).parquet(out).count() == 4


def test_likeliest_tokens_by_batch(spark):
    states = spark.createDataFrame([(1, [0.1, 0.5, 0.5, 0.9]), (2, None), (3, [0.0])], "qid int, p array<double>")
    got = {r["qid"]: [(t["token"], t["p"]) for t in r["first"]] for r in M.with_likeliest(states, {"first": [True, True, True, False]}, 2).collect()}
    assert got == {1: [(1, 0.5), (2, 0.5)], 2: [], 3: [(0, 0.0)]}


def test_the_fold_of_a_book_has_no_texts(spark):
    rows = spark.createDataFrame([(None, "1", "p", 1, "one"), (None, "2", "p", 1, "two"), ("b", "3", None, 2, "one"), ("b", "3", None, 2, "one")], "isbn string, paragraph_id string, page string, position long, text string")
    light = G.without_texts(rows)
    assert "text" not in light.columns
    got = sorted((r["isbn"] or "", r["paragraph_id"], r["text"]) for r in G.with_texts(light, rows).collect())
    assert got == [("", "1", "one"), ("", "2", "two"), ("b", "3", "one"), ("b", "3", "one")]


def test_pairs_of_a_large_pool_are_made_in_blocks(spark):
    """no join of a whole pool with itself, and the same rows, also with null, short, zero and repeated vectors."""
    some = np.random.default_rng(5).normal(size=(40, 4)).round(2).tolist()
    rows = [(k % 2, k, v) for k, v in enumerate(some)] + [(0, 40, None), (0, 41, [0.5, None, 1.0, 2.0]), (1, 42, [0.0] * 4), (1, 43, [0.0]), (0, 44, [1.0, 2.0]), (0, 44, some[0]), (2, 45, some[1]), (None, 46, some[2]), (0, None, some[3]), (1, 47, [])]
    pools = spark.createDataFrame(rows, "qid int, i long, embedding array<float>")
    rounded = lambda df: sorted(map(str, df.select("qid", "i", "j", F.round("distance", 9).alias("d")).collect()))
    expected = rounded(C.pair_distances(pools))
    assert rounded(C.all_pair_distances(pools, block=6)) == rounded(C.all_pair_distances(pools)) == expected
    plan = QUERIES["pairwise_distance"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and plan.count("Join") == 1
