import math

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowtide.functions.numeric import erf, erf_array, erfinv, erfinv_array
from rowtide.plans.feature_row import quantised
from rowtide.spec import PanelSpec


@given(st.floats(-8, 8))
def test_erf(x):
    assert erf_array(np.array([x]))[0] == pytest.approx(math.erf(x), abs=1e-15)


@given(st.floats(-0.99999, 0.99999))
def test_erfinv_inverts_erf(x):
    assert math.erf(erfinv_array(np.array([x]))[0]) == pytest.approx(x, abs=2e-15)


def test_columns_equal_arrays(spark):
    xs = [-0.9999, -0.5, 0.0, 0.3, 0.86, 0.9999, 1.0 - 1e-14]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select(
        erfinv(F.col("x")).alias("i"), erf(F.col("x") * 3).alias("e")
    )
    rows = df.collect()
    assert [r["i"] for r in rows] == pytest.approx(list(erfinv_array(np.array(xs))), abs=1e-14)
    assert [r["e"] for r in rows] == pytest.approx(list(erf_array(np.array(xs) * 3)), abs=1e-15)


def test_quantise_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (-0.125,), (None,)], "x double")
    assert [r[0] for r in quantised(df, PanelSpec("x", ("x",), ("x",))).collect()] == [0.12, 0.38, -0.12, None]
