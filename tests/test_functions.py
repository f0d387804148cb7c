"""Expressions on hand-written cases."""

import pytest
from pyspark.sql import functions as F

from qanvas.functions import extract as E
from qanvas.functions import text as X
from qanvas.functions import vector as V


def value(spark, column, **fields):
    fields = fields or {"x": ""}
    df = spark.createDataFrame([tuple(fields.values())], ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in fields.items()))
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("According to the study, it works.", "it works."),
        ("It works according to Smith. Next.", "It works Next."),
        ("It works according to Smith", "It works according to Smith"),
        ("per according to 3.5 mg, ok", "per 5 mg, ok"),
        (None, ""),
        ("", ""),
    ],
)
def test_clean_references(spark, given, wanted):
    assert value(spark, X.clean_references("x"), x=given) == wanted


@pytest.mark.parametrize(("given", "wanted"), [("mRNA vaccine", "Mrna vaccine"), ("DNA", "DNA"), ("ärger", "Ärger"), ("", ""), ("1a", "1a")])
def test_capitalised(spark, given, wanted):
    assert value(spark, X.capitalised("x"), x=given) == wanted


def test_paragraphs_are_numbered_after_blanks_go_and_sentences_before(spark):
    assert value(spark, X.paragraphs("x"), x="a\n\n \n\nb") == ["a", "b"]
    assert value(spark, X.sentence_parts("x"), x="A. B! C") == ["A.", "B!", "C"]
    assert value(spark, X.sentences("x"), x="") == []


def test_between_marks(spark):
    mark = lambda n: X.between_marks("x", "<s>", "<e>", n)
    assert value(spark, mark(1), x="a<s> b <e>c<s>d<e>") == "b"
    assert value(spark, mark(2), x="a<s> b <e>c<s>d<e>") == "d"
    assert value(spark, mark(3), x="a<s> b <e>c<s>d<e>") is None
    assert value(spark, mark(1), x="<e>x<s>") == ""


@pytest.mark.parametrize(("word", "wanted"), [("don't", True), ("it's", True), ("rock'n", False), ("well-known", True), ("x2", False), ("a'b'c", False), ("they'll", True)])
def test_is_word(spark, word, wanted):
    assert value(spark, X.is_word("x"), x=word) is wanted


def test_masks(spark):
    assert value(spark, X.mask_word("x"), x='"word,"') == '"[MASK],"'
    assert value(spark, X.mask_word("x"), x="...") == "..."
    assert value(spark, X.mask_answer(F.lit("q"), "x", F.lit("b a b"), "<m>", F.lit(2)), x="b") == "q <m> <m> <m> <m> a <m> <m>"


def test_short_and_true_false(spark):
    assert value(spark, E.short("x"), x="**Question:** Q?\n**Answer:** one two  three\nfour").asDict() == {"question": "Q?", "answer": "one two"}
    assert value(spark, E.short("x"), x="Question: Q?") is None
    assert value(spark, E.true_false("x"), x="**Statement:** S\n**Answer:** FALSE.")["answer"] == "False"
    assert value(spark, E.true_false("x"), x="**Statement:** S\n**Answer:** [True]") is None


def test_listing_is_linear_without_an_answer(spark):
    text = "**Question:** q\n**Options:**\n" + "- a\n" * 400
    assert value(spark, E.listing("x"), x=text) is None
    got = value(spark, E.listing("x"), x="**Question:** q\n**Options:**\n- b-c\n- -x\n**Answer:**\n- b-c")
    assert (got["options"], got["answer"]) == (["b-c", "x"], ["b-c"])


def test_multiple_choice_anchors_options(spark):
    text = "**Question:** q\n**Options:**\nA: Vitamin B12\nB: heparin\nC: statin\nD: insulin\n**Answer:** B"
    got = value(spark, E.multiple_choice("x"), x=text)
    assert [got[f"option_{k}"] for k in "abcd"] == ["Vitamin B12", "heparin", "statin", "insulin"]
    assert value(spark, E.multiple_choice("x", anchored=False), x=text)["option_b"] == "12\nB: heparin"
    by_place = value(spark, E.multiple_choice("x"), x="**Question:** q\n**Options:**\n1 one\n2 two\n3 three\n4 four\n**Answer:** D")
    assert by_place["option_d"] == "four"
    assert value(spark, E.multiple_choice("x"), x="**Question:** q\n**Options:**\nA: a\n**Answer:** A") is None


def test_multi_hop_needs_all_fields(spark):
    assert value(spark, E.multi_hop("x"), x="**Question:** **Q**\n**Answer:** A\n**Reasoning:** a\n\n b")["reasoning"] == ["a", "b"]
    assert value(spark, E.multi_hop("x"), x="**Question:** Q\n**Answer:** A\n**Reasoning:**") is None
    assert value(spark, E.multi_hop_inverse("x"), x="**Question:** Q\n**Answer:** A\n**Reasoning:** r\n**Incorrect Reasoning Step:**") is None


def test_cosine_of_zero_vectors_is_one(spark):
    row = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0], [0.0, 2.0])], "a array<double>, b array<double>, c array<double>")
    got = row.select(V.cosine("a", "b").alias("x"), V.cosine("b", "c").alias("y"), V.cosine("b", "b").alias("z")).first()
    assert (got["x"], got["y"], got["z"]) == (1.0, 0.0, 1.0)
