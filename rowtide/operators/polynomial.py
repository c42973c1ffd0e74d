"""Polynomial features from a table of exponents.

The exponents of every output follow from columns and degree alone, so names and order are the same for
training and test tables: the columns themselves, then products by rising degree, in the order of the
columns (``a``, ``b``, ``a^2``, ``a b``, ``b^2``, ..). Wide results are plain columns; ``sparse`` gives the
products that are not zero as (row, place, value) instead, for columns that are mostly zero, such as
flags: only the columns of a row that are not zero are multiplied.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain, combinations, combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.functions.text import name

MAX_COLUMNS = 10_000
Exponents = tuple[tuple[str, int], ...]


def exponent_table(columns: Sequence[str], degree: int = 2, interactions_only: bool = False, bias: bool = False) -> list[Exponents]:
    """(column, power) factors of every output, in order; the bias has none."""
    pick = combinations if interactions_only else combinations_with_replacement
    terms = chain.from_iterable(pick(columns, d) for d in range(0 if bias else 1, degree + 1))
    out = []
    for term in terms:
        out.append(tuple((c, term.count(c)) for c in dict.fromkeys(term)))
    return out


def feature_name(term: Exponents) -> str:
    return " ".join(c if p == 1 else f"{c}^{p}" for c, p in term) or "1"


def _product(term: Exponents) -> str:
    factors = [f"CAST({name(c)} AS DOUBLE)" for c, p in term for _ in range(p)]
    return " * ".join(factors) or "1D"


def polynomial(
    df: DataFrame, columns: Sequence[str], degree: int = 2, interactions_only: bool = False, bias: bool = False
) -> DataFrame:
    """Replace ``columns`` by all products up to ``degree``; a missing factor makes its products missing."""
    if degree < 1:
        raise ValueError("the degree is one at least")
    terms = exponent_table(columns, degree, interactions_only, bias)
    if len(terms) > MAX_COLUMNS:
        raise ValueError(f"polynomial features would be {len(terms)} columns; up to {MAX_COLUMNS} are made")
    kept = [c for c in df.columns if c not in columns]
    names = [*kept, *[feature_name(t) for t in terms]]
    again = sorted({n for n in names if names.count(n) > 1}) if len(set(names)) < len(names) else []
    if again:
        raise ValueError(f"duplicate output columns: {again}")
    return df.selectExpr(*[name(c) for c in kept], *[f"{_product(t)} AS {name(feature_name(t))}" for t in terms])


def sparse_pairs(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep``, place, feature, value of all columns and products of two that are not zero.

    ``place`` is that of ``exponent_table(columns, 2)``. A missing value is left out like a zero.
    """
    n = len(columns)
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(name(c)).cast("double").alias("x")) for i, c in enumerate(columns)])
    held = df.select(*[F.col(name(c)) for c in keep], F.filter(cells, lambda c: c["x"] != 0).alias("__cells"))
    single = "transform(__cells, c -> struct(c.i AS place, c.x AS value, c.i AS a, -1 AS b))"
    # The place of (a, b), a <= b, after the columns themselves: all pairs of earlier a, then those of this one.
    place = f"{n} + c.i * {n} - c.i * (c.i - 1) div 2 + d.i - c.i"
    pairs = (
        "flatten(transform(__cells, (c, k) -> transform(slice(__cells, k + 1, size(__cells)), "
        f"d -> struct(CAST({place} AS INT) AS place, c.x * d.x AS value, c.i AS a, d.i AS b))))"
    )
    names = F.array(*[F.lit(c) for c in columns])
    out = held.select(*[F.col(name(c)) for c in keep], F.inline(F.expr(f"concat({single}, {pairs})")))
    a, b = F.get(names, F.col("a")), F.get(names, F.col("b"))
    shown = F.when(F.col("b") < 0, a).when(F.col("a") == F.col("b"), F.concat(a, F.lit("^2"))).otherwise(F.concat(a, F.lit(" "), b))
    return out.select(*[F.col(name(c)) for c in keep], "place", shown.alias("feature"), "value")
