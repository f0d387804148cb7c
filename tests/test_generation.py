"""The generation flow: batch and stream agree, crashes leave no trace, steps go on where they stopped, long scopes fold."""

import json

import pytest
from pyspark.sql import functions as F

from qanvas.operators import generation as G
from qanvas.operators import questions as Q
from qanvas.plans import generation_queries as P
from qanvas.plans.vector_queries import arrivals_of
from qanvas.session import shared_folder
from qanvas.sources import sinks as S
from qanvas.streaming import generation as T

from .conftest import SF

TEXT = "In 1905 Ada Lovelace wrote down a long and careful note, and then a second one. It is about seven machines, and what they could do."


@pytest.fixture(scope="module")
def paragraphs(spark):
    rows = [(f"b{i % 3}", str(i), str(i // 10), i, TEXT if i % 4 else "too short") for i in range(60)]
    return spark.createDataFrame(rows, "isbn string, paragraph_id string, page string, position long, text string")


def stream_of(spark, paragraphs, folder, part):
    paragraphs.where(F.floor(F.col("position") / 20) == part).write.parquet(f"{folder}/aside/{part}")
    S.move(spark, f"{folder}/aside/{part}", f"{folder}/in/{part}")


def rows_of(df):
    return sorted(tuple(r) for r in df.select("type", "isbn", "record").collect())


def test_records_have_their_source_and_type(spark, paragraphs):
    got = G.generated(paragraphs, P.templates(spark), P.completed)
    records = [(r["type"], r["isbn"], json.loads(r["record"])) for r in got.collect()]
    kept = [i for i in range(60) if i % 4 and i % 11]
    assert sorted(int(r["source"]["paragraph_id"]) for _, _, r in records) == kept
    assert all(list(r) == sorted(r) and r["source"] == {"isbn": b, "page": str(int(r["source"]["paragraph_id"]) // 10), "paragraph_id": r["source"]["paragraph_id"]} for _, b, r in records)
    assert len({t for t, _, _ in records}) >= 4
    assert G.generated(paragraphs.limit(0), P.templates(spark), P.completed).count() == 0


def test_a_crash_at_any_place_leaves_the_same_files(spark, paragraphs):
    """The second batch fails while it generates, then after its questions are written; in the end all is as in a batch."""
    folder = shared_folder(spark, "flow")
    start = lambda generate=P.completed: T.generate_stream(spark.readStream.schema(paragraphs.schema).parquet(f"{folder}/in/*"), P.templates(spark), generate, folder)
    stream_of(spark, paragraphs, folder, 0)
    start().awaitTermination()
    first = rows_of(T.questions(spark, folder))
    stream_of(spark, paragraphs, folder, 1)

    def broken(rows):
        raise RuntimeError("the model is gone")

    with pytest.raises(Exception, match="the model is gone"):
        start(broken).awaitTermination()
    assert rows_of(T.questions(spark, folder)) == first
    was = S.manifest_rows
    S.manifest_rows = broken
    try:
        with pytest.raises(Exception, match="the model is gone"):
            start().awaitTermination()
    finally:
        S.manifest_rows = was
    start().awaitTermination()
    stream_of(spark, paragraphs, folder, 2)
    start().awaitTermination()
    start().awaitTermination()  # nothing new: nothing happens
    want = rows_of(G.generated(paragraphs, P.templates(spark), P.completed))
    assert rows_of(T.questions(spark, folder)) == want
    files = sorted((r["file_name"], r["type"], r["isbn"]) for r in T.manifest(spark, folder).collect())
    assert files == sorted(tuple(r) for r in S.manifest_rows(T.questions(spark, folder).select("type", "isbn").distinct()).collect())
    done = {r["isbn"]: (r["paragraphs"], r["questions"]) for r in T.progress(spark, folder).collect()}
    assert done == {f"b{k}": (sum(1 for i in range(60) if i % 3 == k and i % 4), sum(1 for i in range(60) if i % 3 == k and i % 4 and i % 11)) for k in range(3)}


def test_steps_go_on_where_they_stopped(spark):
    rows = spark.range(103).select(F.col("id"), (F.col("id") * 7 % 103).alias("x"))
    seen = []

    def work(part):
        seen.append(part.count())
        return part.select("id", (F.col("x") + 1).alias("y"))

    one = T.in_steps(rows, ["id"], work, shared_folder(spark, "steps"), 20)
    assert seen == [20] * 5 + [3]
    folder, calls = shared_folder(spark, "steps"), []

    def failing(part):
        calls.append(sorted(r["id"] for r in part.collect()))
        if len(calls) == 3:
            raise RuntimeError("gone")
        return work(part)

    with pytest.raises(RuntimeError):
        T.in_steps(rows, ["id"], failing, folder, 20)
    done = spark.read.parquet(f"{folder}/done")
    assert sorted(r["id"] for r in done.collect()) == list(range(40))  # a prefix of the rows
    assert T.in_steps(rows, ["id"], failing, folder, 20, stop_after=1) is None
    again = T.in_steps(rows, ["id"], failing, folder, 20)
    assert [c[0] for c in calls] == [0, 20, 40, 40, 60, 80, 100]  # what was done is not done again
    assert sorted(again.collect()) == sorted(one.collect())
    assert T.in_steps(rows.limit(0), ["id"], lambda p: p, shared_folder(spark, "steps"), 20).count() == 0


def test_long_scopes_fold_from_range_to_range(spark):
    """Scopes over many ranges, several in one range, and a null scope: as the fold of whole scopes."""
    events = spark.range(600).select(F.when(F.col("id") < 420, 0).when(F.col("id") < 450, F.col("id") % 7 + 1).otherwise(9).alias("user_id"), F.col("id").alias("event_id"))
    rows = arrivals_of(events)
    want = sorted((r["scope"], r["event_id"], r["assigned"]) for r in Q.balanced(rows, ["scope"], ["event_id"]).collect())
    for ranges in (1, 5, 16):
        got = sorted((r["scope"], r["event_id"], r["assigned"]) for r in Q.balanced_ranges(rows, "scope", "event_id", ranges=ranges).collect())
        assert got == want
    nulls = rows.withColumn("scope", F.when(F.col("scope") != 0, F.col("scope")))
    got = {r["event_id"]: r["assigned"] for r in Q.balanced_ranges(nulls, "scope", "event_id", ranges=6).collect()}
    assert got == {e: a for _, e, a in want}
    assert Q.balanced_ranges(rows.limit(0), "scope", "event_id").count() == 0


def test_chunks_follow_the_order(spark):
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), F.lit("x").alias("c0"), F.lit(1).alias("part"))
    got = {r["k"]: r["chunk"] for r in S.chunked(rows, ["k"], 64, "n").collect()}
    assert got == {k: f"n_{k // 64 + 1:03}" for k in range(1000)}
    assert S.chunked(rows, ["k"]).columns == ["k", "c0", "part", "chunk"]


def test_flow_queries_agree(spark):
    a, b = (sorted(tuple(r) for r in f(spark, SF).collect()) for f in (P.generate_batch, P.generate_flow))
    assert a == b


def test_command_line(spark, paragraphs, tmp_path):
    """Books, prompts and a generator by name; a second run appends nothing; a query by name; bad settings are refused."""
    from qanvas.__main__ import GenerateConfig, main, parser

    nested = S.nested_books(paragraphs.select("isbn", F.lit("t").alias("title"), "position", "paragraph_id", F.lit("s").alias("section"), F.col("page").cast("int").alias("page"), "text"))
    S.write_books(nested, f"{tmp_path}/books")
    for r in P.templates(spark).collect():
        (tmp_path / "prompts").mkdir(exist_ok=True)
        (tmp_path / "prompts" / f"{r['name']}.prompt").write_text(r["template"])
    call = ["generate", "--books", f"{tmp_path}/books", "--prompts", f"{tmp_path}/prompts", "--out", f"{tmp_path}/out", "--generator", "qanvas.plans.generation_queries:completed"]
    main(call)
    saved = spark.read.schema(G.SAVED).parquet(f"{tmp_path}/out/questions")
    assert saved.count() == len([i for i in range(60) if i % 4 and i % 11])
    files = spark.read.option("header", True).csv(f"{tmp_path}/out/manifest").count()
    assert files == saved.select("type", "isbn").distinct().count()
    main(call)
    assert spark.read.schema(G.SAVED).parquet(f"{tmp_path}/out/questions").count() == saved.count()
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/manifest").count() == files
    some = [*call[:5], "--out", f"{tmp_path}/some", *call[7:], "--start", "5", "--max-entries", "10"]
    main(some)
    assert spark.read.schema(G.SAVED).parquet(f"{tmp_path}/some/questions").count() < saved.count()
    main(["query", "chunk_rows", "--tables", SF, "--out", f"{tmp_path}/chunks"])
    assert spark.read.parquet(f"{tmp_path}/chunks").count() == 200
    with pytest.raises(ValueError, match="negative"):
        GenerateConfig("b", "p", "o", start=-1, generator="m:f")
    with pytest.raises(SystemExit):
        parser().parse_args(["generate", "--books", "b"])
