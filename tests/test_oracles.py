"""Every query with an oracle, against DuckDB."""

import pytest

from qanvas.plans.registry import ORACLES, QUERIES

from .conftest import SF
from .helpers import same


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    same(QUERIES[name](spark, SF), duck.sql(ORACLES[name]))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
