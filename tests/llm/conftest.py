"""A small table of awkward documents: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, score double, y int, weight long, `__score` double"
BASE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from the old oak tree near the river bank at dusk"


def row(doc_id, text):
    return (doc_id, text, "en", "s", None if text is None else len(text), "k", 1.0, 1, 2, None)


@pytest.fixture(scope="session")
def awkward(spark):
    texts = [
        (1, BASE), (2, BASE.upper() + "!"), (3, BASE.replace("dusk", "dawn")), (4, ""), (5, None), (6, "   \n\t "), (7, "one two"), (8, "one two"), (8, "one two"),
        (9, "é ü ß 漢字 " * 3), (10, "w" * 30_000), (11, " ".join(f"word{i % 977}" for i in range(40_000))), (None, "no id here at all"), (None, None), (12, "!!! ???"), (13, "--- ..."),
    ]
    return spark.createDataFrame([row(*t) for t in texts], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 12)] + [(3, None, None), (None, 1, 1), (3, 0, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def duck():
    """The tables of the other tests and the shop's."""
    import duckdb

    from ..conftest import SF, TABLES

    con = duckdb.connect()
    for t in [*TABLES, "clicks", "sales", "sale_lines", "clients", "client_changes", "vendors", "items", "stamps"]:
        con.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con
