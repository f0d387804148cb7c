"""Stems, pools, beams, windows and pooling by hand and by brute force."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from qanvas.functions import text as X
from qanvas.functions.stem import stem
from qanvas.operators import choices as C
from qanvas.operators import masked as M

#: Words and stems as published with the algorithm.
STEMS = """caresses caress ponies poni ties tie cats cat feed feed agreed agre plastered plaster bled bled motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan
falling fall hissing hiss fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit rational ration valenci valenc hesitanci hesit digitizer digit conformabli conform
radicalli radic differentli differ vileli vile analogousli analog vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis hopefulness hope callousness callous
formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic formative form formalize formal electriciti electr electrical electr hopeful hope goodness good revival reviv allowance allow
inference infer airliner airlin gyroscopic gyroscop adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust dependent depend adoption adopt homologou homolog
communism commun activate activ angulariti angular homologous homolog effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll""".split()  # fmt: skip


def test_stems_as_published(spark):
    rows = list(zip(STEMS[::2], STEMS[1::2], strict=True)) + [("Dying", "die"), ("a", "a"), ("is", "is"), ("", ""), (None, None), ("yes", "ye"), ("Relational", "relat"), ("cried", "cri"), ("died", "die"), ("über", "über")]
    assert [(r["w"], r["got"]) for r in spark.createDataFrame(rows, "w string, s string").withColumn("got", stem("w")).collect()] == rows


def words_of(*words, **flags):
    n = len(words)
    known = [w.isalpha() for w in words]
    stems = flags.get("stems", [w.lower().rstrip("s") for w in words])
    return M.Vocabulary(np.array(words, dtype=object), np.array(flags.get("suffix", [False] * n)), np.array(known), np.array([w == "damn" for w in words]), np.array(stems, dtype=object), flags.get("vectors"))


def reference_scan(v, score, answer, answer_stem, passage, before, after, cosine, size, unlike, in_text_only):
    """The rules one token after another over a full sort."""
    out, used, text = [], {answer_stem}, passage.lower().split()
    for place, t in enumerate(sorted(range(len(v.word)), key=lambda i: (-score[i], i)), 1):
        w = v.word[t]
        if w.isupper() != answer.isupper():
            continue
        rules = [
            ("short", len(w) < 2), ("first letter", w[:1].isupper() != answer[:1].isupper()), ("profane", v.profane[t]), ("not a word", not v.known[t] and w.lower() not in text),
            ("neighbour", w.lower() in (before, after)), ("digit", any(c.isdigit() for c in w)), ("not in text", in_text_only and w.lower() not in text), ("stem", v.stem[t] in used),
        ]
        why = next((name for name, bad in rules if bad), None)
        if why is None:
            used.add(v.stem[t])
        elif cosine is None or cosine[t] >= unlike:
            continue
        out.append((t, place, why))
        if len(out) >= size:
            break
    return out


def test_pools_equal_a_scan_of_the_whole_order():
    rng = random.Random(2)
    for trial in range(60):
        words = ["".join(rng.choice("abS1s") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 150))] + ["damn", "CAPS"]
        v = words_of(*words)
        score = np.round(np.array([rng.choice([0.1, 0.2, rng.random()]) for _ in words]), 2)
        cosine = None if trial % 3 == 0 else np.array([rng.random() for _ in words])
        args = (v, score, rng.choice(["a", "A", "abs", ""]), "ab", " ".join(rng.sample(words, min(5, len(words)))), rng.choice(words).lower(), "b", cosine, rng.choice([1, 3, 8]), 0.4, trial % 5 == 0)
        assert M.scanned(*args) == reference_scan(*args)


def test_used_stems_are_those_of_accepted_words_only():
    """Three words of one stem: the first is rejected as a neighbour, so the second may have the stem, the third not."""
    v = words_of("cat", "cats", "Cat", "catss", stems=["cat"] * 4)
    assert M.scanned(v, np.array([4.0, 3, 2, 1]), "dog", "dog", "x", "cat", "y", None, 9, 0.8, False) == [(1, 2, None)]


def test_falling_blocks_stop_early_and_miss_nothing():
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 1000):
        score = np.round(rng.random(n), 2)
        blocks = list(M.falling_blocks(score, 8))
        assert np.concatenate([*blocks, []]).astype(int).tolist() == sorted(range(n), key=lambda i: (-score[i], i))
        assert n < 1000 or len(blocks[0]) < 40


def test_mask_pools_take_anything(spark):
    tokens = spark.createDataFrame([(0, "red", False, None), (1, "blue", False, None), (2, "ing", True, None), (3, None, False, None)], "token int, word string, suffix boolean, vector array<float>").withColumns({"known": F.lit(True), "profane": F.lit(None).cast("boolean")})
    v = M.vocabulary_of(tokens)
    p = [0.4, 0.3, 0.2, 0.1]
    rows = [(1, "green", "a <mask> b", p, p[::-1], None), (2, None, None, p, p, [1.0]), (3, "x", "y", None, p, None), (4, "x", "y", p[:2], p, None)]
    got = M.mask_pools(spark.createDataFrame(rows, "qid long, answer string, passage string, p_sentence array<double>, p_passage array<double>, vector array<float>"), v, 2).collect()
    assert [(r["qid"], r["slot"], r["word"], r["place"]) for r in got if r["qid"] == 1] == [(1, 1, "red", 1), (1, 2, "blue", 2)]
    assert {r["qid"] for r in got} == {1, 2}
    with pytest.raises(ValueError, match="gaps"):
        M.vocabulary_of(tokens.where("token <> 1"))
    assert M.neighbours("The <MASK>. end", "<mask>") == ("the", "end") and M.neighbours("none", "<mask>") == ("beforeanytext", "afteralltext")


def test_beam_equals_exhaustive_search_when_it_covers_all(spark):
    rng = random.Random(4)
    pieces = [(a + b, s) for s in (False, True) for a in "ab" for b in "cd"]
    known = {"".join(w) for w in itertools.product(["ac", "ad", "bc", "bd"], repeat=3) if rng.random() < 0.3} | {"acac", "bdbd"}
    table = {}

    def p(qid, tokens):
        return table.setdefault((qid, tokens), [round(rng.random(), 3) for _ in pieces])

    def best(qid, tokens, left):
        """The recursion: the likeliest word here, else a likelier one behind a suffix."""
        own, text = p(qid, tokens), "".join(pieces[t][0] for t in tokens)
        order = lambda suffix: sorted((t for t in range(len(pieces)) if pieces[t][1] == suffix), key=lambda t: (-own[t], t))
        ids, prob = next(([t], own[t]) for t in [*order(False), None] if t is None or pieces[t][0] + text in known) if any(pieces[t][0] + text in known for t in order(False)) else ([], 0.0)
        for t in order(True) if left > 1 else ():
            deeper, found = best(qid, (t, *tokens), left - 1)
            if found > prob:
                ids, prob = [*deeper, t], found
        return ids, prob

    asked = [(q, start, depth) for q in range(6) for start in (4, 7) for depth in (0, 1, 3)]
    asked = [(q * 10 + d, s, d) for q, s, d in asked]
    want = {(q, s): best(q, (s,), d) if d else ([], 0.0) for q, s, d in asked}
    score_of = F.udf(lambda q, t: p(q, tuple(t)), "array<double>")
    scores = {k: v for k, v in table.items()}
    score_of = F.udf(lambda q, t: scores.get((q, tuple(t))) or [0.0] * len(pieces), "array<double>")
    words = spark.createDataFrame([(w.upper(),) for w in known], "word string")
    got = M.beam_suffixes(spark.createDataFrame(asked, "qid long, start int, depth int"), pieces, words, lambda s: s.withColumn("p", score_of("qid", "tokens")), width=4).collect()
    assert {(r["qid"], r["start"]): (r["tokens"], r["p"]) for r in got} == {k: ([*ids, k[1]] if ids else [], prob) for k, (ids, prob) in want.items()}
    narrow = M.beam_suffixes(spark.createDataFrame(asked, "qid long, start int, depth int"), pieces, words, lambda s: s.withColumn("p", score_of("qid", "tokens")), width=1).collect()
    assert all(r["p"] <= want[r["qid"], r["start"]][1] for r in narrow)
    assert M.beam_suffixes(spark.createDataFrame([], "qid long, start int, depth int"), pieces, words, lambda s: s).count() == 0


def test_windows_round_any_sentence_equal_the_fold(spark):
    rng = random.Random(3)
    texts = [(i, [" ".join(["w"] * rng.randint(1, 9)) for _ in range(rng.randint(0, 12))]) for i in range(25)]
    df = spark.createDataFrame(texts, "key long, sentences array<string>")
    for least in (1, 10, 25, 10_000):
        got = {(r["key"], r["at"]): (r["lo"], r["hi"], r["n_words"]) for r in M.sentence_windows(df, least).collect()}
        assert len(got) == sum(len(s) for _, s in texts)
        each = df.select("key", "sentences", F.posexplode("sentences").alias("at", "s"))
        for r in each.withColumn("w", C.context_window(F.col("sentences"), F.col("at"), least)).collect():
            lo, hi, n = got[r["key"], r["at"]]
            assert " ".join(r["sentences"][lo : hi + 1]) == r["w"] and n == len(r["w"].split())


def test_every_mask_is_inside_its_window(spark):
    texts = spark.createDataFrame([(1, ["<m>" if i % 7 == 3 else "w" for i in range(95)]), (2, []), (3, None), (4, ["<m>"])], "key long, tokens array<string>")
    rows = M.mask_windows(texts, lambda t: t == "<m>", limit=20, step=8).collect()
    assert sorted((r["key"], r["mask_at"]) for r in rows) == [(1, i) for i in range(3, 95, 7)] + [(4, 0)]
    for r in rows:
        assert r["window"][r["mask_in"]] == "<m>" and len(r["window"]) <= 20
        assert r["dropped"] == (0 if r["mask_at"] < 20 else 8 * math.ceil((r["mask_at"] - 19) / 8))


def test_masked_mean(spark):
    rows = [(1, [[1.0, 2.0], [3.0, 6.0], [9.0, 9.0]], [1, 1, 0]), (2, [[1.0, 2.0]], [0]), (3, [], []), (4, [[5.0, 5.0], [1.0, 1.0]], [None, 1])]
    df = spark.createDataFrame(rows, "k int, v array<array<double>>, m array<int>")
    assert {r["k"]: r["x"] for r in df.select("k", M.masked_mean("v", "m").alias("x")).collect()} == {1: [2.0, 4.0], 2: None, 3: None, 4: [1.0, 1.0]}


def test_flow_without_a_pool_or_with_few(spark):
    """No vocabulary and no lexicon: the completion, its default, and the comma parts."""
    v = M.vocabulary_of(spark.createDataFrame([], "token int, word string, suffix boolean, vector array<float>, known boolean, profane boolean"))
    rows = [(1, "a", ["x"], None, "p, q, a, r, s"), (2, "a", [], "Distractors:\n- one\n- a thing\n• two", None), (3, "b", None, None, None), (4, None, ["x", "y", "z", "w"], None, None)]
    asked = spark.createDataFrame(rows, "qid long, answer string, existing array<string>, completion string, fallback string")
    asked = asked.select("*", F.lit("t").alias("passage"), *[F.lit(None).cast("array<double>").alias(c) for c in ("p_sentence", "p_passage")], F.array(F.lit(1.0).cast("float")).alias("vector"))
    got = {r["qid"]: r for r in M.masked_flow(asked, v, spark.createDataFrame([], "word string"), lambda rows: rows.withColumn("vector", F.array(F.length("word").cast("float"))), exact=True).collect()}
    assert got[1]["distractors"] == ["p", "q", "r"] and got[1]["pool"] == ["x"]
    assert got[2]["distractors"] == ["one", "two"] or got[2]["distractors"] == ["two"]
    assert got[3]["distractors"] == ["Option A", "Option B", "Option C"]
    assert set(got[4]["distractors"]) < {"x", "y", "z", "w"} and len(got[4]["distractors"]) == 3
    assert all(sorted(r["options"]) == sorted([r["answer"], *r["distractors"]]) for r in got.values())


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_close_pairs_miss_none(spark):
    """Short and long texts, around the length where the way changes; first letters differ; repeated letters."""
    rng = random.Random(6)

    def changed(w):
        w = list(w)
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(w) + 1)
            w[i : i + rng.randint(0, 1)] = rng.choice(["", "a", "b", "é"])
        return "".join(w)

    base = ["".join(rng.choice("abé") for _ in range(n)) for n in (1, 2, 3, 4, 8, 20, 22, 23, 24, 25, 26, 27, 28, 40, 90)]
    texts = sorted({t for b in base for t in [b, *[changed(b) for _ in range(6)]] if t})
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {(r["text"], r["match"]): r["edits"] for r in C.close_pairs(df).collect()}
    assert got == {(a, b): d for a in texts for b in texts if a != b and (d := edits(a, b)) <= 2}
    nearest = {r["text"]: r["match"] for r in C.close_match(df.unionByName(df)).collect()}
    assert nearest == {a: min((d, b) for (x, b), d in got.items() if x == a)[1] for a in {a for a, _ in got}}


def test_diversity_is_the_mean_over_pairs(spark):
    rng = np.random.default_rng(1)
    rows = [(q, i, rng.normal(size=4).tolist() if (q + i) % 5 else [0.0] * 4) for q in range(3) for i in range(7)] + [(9, 1, [0.0] * 4)]
    got = {(r["qid"], r["i"]): r["diversity"] for r in C.diversity(spark.createDataFrame(rows, "qid long, i long, embedding array<float>")).collect()}

    def cosine(x, y):
        n = np.linalg.norm(x) * np.linalg.norm(y)
        return 1.0 if n == 0 else np.dot(x, y) / n

    for q, i, x in rows:
        x = np.float32(x)
        assert math.isclose(got[q, i], np.mean([1 - cosine(x, np.float32(y)) for p, _, y in rows if p == q]), abs_tol=1e-6)


def test_word_count_of_windows_is_split_like_words(spark):
    assert spark.range(1).select(X.word_count(F.lit(" a  b ")).alias("n")).first()["n"] == 2


def test_principal_components_equal_a_decomposition(spark):
    from qanvas.operators.projection import principal_axes, projected

    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 5)) * [5, 1, 3, 0.1, 0.5] + 7
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0]), (902, [float("nan")] * 5)]
    df = spark.createDataFrame(rows, "i long, v array<double>").repartition(7)
    _, _, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    want = (x - x.mean(0)) @ vt[:2].T
    got = {r["i"]: (r["pc1"], r["pc2"]) for r in projected(df, "v").collect()}
    for k in range(2):
        own = np.array([got[i][k] for i in range(300)])
        assert min(np.abs(own - want[:, k]).max(), np.abs(own + want[:, k]).max()) < 1e-6
    assert got[900] == got[902] == (None, None)
    mean, axes, values = principal_axes(df, "v", 5)
    assert np.allclose(values, np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]) and all(a[np.abs(a).argmax()] > 0 for a in axes)
    assert projected(df.limit(0), "v").columns == ["i", "v", "pc1", "pc2"]
    assert {r["pc1"] for r in projected(df.where("i < 1"), "v").collect()} == {None}
