"""Narrow types that are stored once, and the first rows of a panel."""

import pytest
from conftest import SMALL

from rowtide.operators.columns import cast_to, narrow, narrow_types, schema_difference, stored_types
from rowtide.sources.panel import read_panel
from rowtide.spec import PanelSpec

SCHEMA = "id bigint, small bigint, large bigint, x double, y double"


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_the_first_table_decides_the_types(spark, tmp_path):
    path = str(tmp_path / "types")
    first = frame(spark, (1, 5, 2**40, 1.5, 1e300), (2, None, 1, None, float("inf")))
    second = frame(spark, (1, 6, 7, 2.5, 3.5))  # by itself all of it would be narrow
    types = stored_types(first, path, ["id"])
    assert types == {"small": "int", "x": "float"} == narrow_types(first, ["id"])
    assert stored_types(second, path, ["id"]) == types
    a, b = cast_to(first, types), cast_to(second, types)
    assert schema_difference(a, b) == [] and schema_difference(narrow(second), a) != []
    assert [tuple(r) for r in b.collect()] == [(1, 6, 7, 2.5, 3.5)]
    assert a.filter("y > 1e308").count() == 1 and a.filter("id = 2 AND small IS NULL AND x IS NULL").count() == 1


@pytest.mark.parametrize("row", [(1, 2**31, 1, 1.0, 1.0), (1, -(2**31) - 1, 1, 1.0, 1.0), (1, 1, 1, 1e39, 1.0)])
def test_a_value_that_does_not_fit_is_an_error(spark, row):
    with pytest.raises(Exception, match="does not fit"):
        cast_to(frame(spark, row), {"small": "int", "x": "float"}).collect()


def test_ends_of_the_types_fit(spark):
    rows = frame(spark, (1, 2**31 - 1, 1, 3.4e38, 1.0), (2, -(2**31), 1, float("-inf"), 1.0), (3, 0, 0, float("nan"), 0.0))
    out = cast_to(rows, {"small": "int", "x": "float"}).orderBy("id").collect()
    assert [r.small for r in out] == [2**31 - 1, -(2**31), 0] and out[1].x == float("-inf")
    with pytest.raises(ValueError, match="missing"):
        cast_to(rows, {"gone": "int"})


def test_the_first_rows_are_the_same_every_time(spark):
    path = f"{SMALL}/orders.parquet"
    spec = PanelSpec("o_custkey", ("o_orderdate", "o_orderkey"), ("o_totalprice",))
    head = [tuple(r) for r in read_panel(spark, path, spec, rows=25).collect()]
    whole = sorted(tuple(r) for r in read_panel(spark, path, spec).collect())
    assert head == whole[:25]
    some = read_panel(spark, path, spec, columns=["o_totalprice"], rows=25)
    assert some.columns == ["o_totalprice"] and [r[0] for r in some.collect()] == [r[3] for r in whole[:25]]
