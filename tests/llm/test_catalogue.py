"""Each corpus query gives the same full result as its SQL; the others are tested with their operators."""

import pytest
from compare import difference
from conftest import SMALL

from rowtide.llm import queries


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, db, name):
    assert difference(queries.QUERIES[name](spark, SMALL), db, queries.ORACLES[name]) is None
