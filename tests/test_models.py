"""The interfaces through which a caller's models come in, with functions in their place, and gates that fail open."""

import pandas as pd
from pyspark.sql import functions as F

from qanvas.functions import models as M
from qanvas.functions import text as X
from qanvas.operators import questions as Q
from qanvas.sources import books as B

ROWS = [(1, "Ada wrote. Bob read."), (2, ""), (3, None)]


def test_an_annotator_replaces_the_stand_ins(spark):
    def annotate(texts: pd.Series) -> pd.DataFrame:
        known = texts.fillna("")
        return pd.DataFrame({"n_sentences": known.str.count(r"\."), "labels": known.map(lambda t: [w for w in ("Ada", "Bob") if w in t]), "entropy": known.str.len() / 10.0})

    got = {r["i"]: (r["n_sentences"], r["labels"], r["entropy"]) for r in M.annotated(spark.createDataFrame(ROWS, "i int, text string"), annotate=annotate).collect()}
    assert got == {1: (2, ["Ada", "Bob"], 2.0), 2: (0, [], 0.0), 3: (0, [], 0.0)}


def test_embeddings_and_completions_by_functions(spark):
    rows = spark.createDataFrame(ROWS, "i int, text string")
    got = {r["i"]: r["embedding"] for r in M.embedded(rows, "text", lambda t: t.fillna("").map(lambda x: [float(len(x)), 1.0])).collect()}
    assert got == {1: [20.0, 1.0], 2: [0.0, 1.0], 3: [0.0, 1.0]}
    loaded = M.generated(rows.na.fill(""), "text", lambda: lambda prompts: [p.upper() + "!" for p in prompts])
    assert {r["i"]: r["completion"] for r in loaded.collect()} == {1: "ADA WROTE. BOB READ.!", 2: "!", 3: "!"}


def test_gates_keep_what_could_not_be_measured(spark):
    rows = spark.createDataFrame([(1, None, 10, None), (2, 0, 0, 0.4), (3, 0, 10, 0.6), (4, 5, 10, float("nan"))], "i int, entities int, words int, variance double")
    got = {r["i"]: (r["d"], r["c"]) for r in rows.select("i", Q.density_gate(F.col("entities"), F.col("words")).alias("d"), Q.coherence_gate(F.col("variance")).alias("c")).collect()}
    assert got[1] == (True, True) and got[2] == (True, True) and got[3] == (False, False) and got[4][0] is True


def test_words_of_a_lexicon(spark):
    known = lambda w: w.isin("x1", "o.k")
    rows = spark.createDataFrame([("x1",), ("o.k",), ("o.k-x1",), ("x2",), ("don't",), ("x1's",), ("o'k",)], "w string")
    assert {r["w"]: r["y"] for r in rows.select("w", X.is_word("w", known).alias("y")).collect()} == {"x1": True, "o.k": True, "o.k-x1": True, "x2": False, "don't": True, "x1's": True, "o'k": False}


def test_saved_arrays_and_records_read_alike(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"question": "a"}\n{"question": "b"}\n')
    (tmp_path / "array.json").write_text('[{"question": "a"},\n {"question": "b"}]')
    schema = spark.createDataFrame([], "question string").schema
    read = lambda name, arrays: sorted(r["question"] for r in B.saved_questions(spark, f"{tmp_path}/{name}", schema, arrays).collect())
    assert read("lines.json", False) == read("array.json", True) == ["a", "b"]
