"""Column-level steps on finished tables: fill, narrow, trim, compare."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rowtide.functions.text import filled, name, quoted
from rowtide.sources.cache import cached_table


def fill_missing(df: DataFrame, fill: float = -1.0, skip: Iterable[str] = ()) -> DataFrame:
    """Missing and infinite numbers become ``fill``; other types are left alone."""
    skip = set(skip)

    def shown(f: T.StructField) -> str:
        c, kind = name(f.name), f.dataType.simpleString()
        if f.name in skip:
            return c
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return f"CAST({filled(c, fill)} AS {kind}) AS {c}"
        if isinstance(f.dataType, (T.IntegralType, T.DecimalType)):
            return f"coalesce({c}, CAST({int(fill)} AS {kind})) AS {c}"
        return c

    return df.selectExpr(*[shown(f) for f in df.schema.fields])


_INT = 2**31
_FLOAT = 3.4028234e38  # what a float holds without becoming infinite


def narrow_types(df: DataFrame, skip: Iterable[str] = ()) -> dict[str, str]:
    """Of long and double columns whose values all fit: the narrower type, ``int`` or ``float``.

    Read off the columns' extremes, so ``df`` is read: pass a stored table.
    """
    skip = set(skip)
    wide = {f.name: f.dataType for f in df.schema.fields if f.name not in skip and isinstance(f.dataType, (T.LongType, T.DoubleType))}
    if not wide:
        return {}
    # Infinite values stay infinite in a float; NaN stays NaN.
    shown = {c: f"CASE WHEN abs({name(c)}) < double('Infinity') THEN {name(c)} END" if isinstance(k, T.DoubleType) else name(c) for c, k in wide.items()}
    ends = df.selectExpr(*[f"min({e})" for e in shown.values()], *[f"max({e})" for e in shown.values()]).first()
    fits = {}
    for (c, kind), low, high in zip(wide.items(), ends[: len(wide)], ends[len(wide) :], strict=True):
        ok = low is None or (-_INT <= low and high < _INT if isinstance(kind, T.LongType) else max(-low, high) <= _FLOAT)
        if ok:
            fits[c] = "int" if isinstance(kind, T.LongType) else "float"
    return fits


def cast_to(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Columns as the types say; a value that does not fit is an error, never another value."""
    wide = {f.name: f.dataType for f in df.schema.fields}
    missing = sorted(set(types) - set(wide))
    if missing:
        raise ValueError(f"columns {missing} of the stored types are missing")

    def shown(c: str) -> str:
        if types[c] == "float" and isinstance(wide[c], T.DoubleType):
            beyond = f"abs({name(c)}) > {_FLOAT!r}D AND abs({name(c)}) < double('Infinity')"
            return f"CASE WHEN {beyond} THEN CAST(raise_error({quoted(f'a value of {c} does not fit a float')}) AS FLOAT) ELSE CAST({name(c)} AS FLOAT) END"
        if types[c] == "int" and isinstance(wide[c], T.LongType):
            beyond = f"{name(c)} NOT BETWEEN {-_INT} AND {_INT - 1}"
            return f"CASE WHEN {beyond} THEN CAST(raise_error({quoted(f'a value of {c} does not fit an int')}) AS INT) ELSE CAST({name(c)} AS INT) END"
        return f"CAST({name(c)} AS {types[c]})"

    return df.selectExpr(*[f"{shown(c)} AS {name(c)}" if c in types else name(c) for c in df.columns])


def narrow(df: DataFrame, skip: Iterable[str] = ()) -> DataFrame:
    """Long to int and double to float, for columns whose values all fit.

    No value is lost; a float keeps some seven digits. The types depend on the values: tables that must
    agree (training and test, chunks) take them from one of them, with ``stored_types``.
    """
    return cast_to(df, narrow_types(df, skip))


def stored_types(df: DataFrame, path: str, skip: Iterable[str] = ()) -> dict[str, str]:
    """The narrower types at ``path``; the first table that comes decides them."""
    spark = df.sparkSession
    rows = cached_table(
        spark, path, lambda: spark.createDataFrame(sorted(narrow_types(df, skip).items()), "feature string, type string").coalesce(1)
    )
    return {r["feature"]: r["type"] for r in rows.collect()}


def drop_matching(df: DataFrame, patterns: Iterable[str], skip: Iterable[str] = ()) -> DataFrame:
    """Drop columns whose name matches any regular expression."""
    tests, skip = [re.compile(p) for p in patterns], set(skip)
    gone = [c for c in df.columns if c not in skip and any(t.search(c) for t in tests)]
    return df.drop(*gone)


def trim_statistics(df: DataFrame, keep: Mapping[str, Iterable[str]]) -> DataFrame:
    """Drop ``{base}_{stat}`` columns whose base is not on the statistic's keep-list."""
    gone = []
    for stat, bases in keep.items():
        bases, suffix = set(bases), f"_{stat}"
        gone += [c for c in df.columns if c.endswith(suffix) and c[: -len(suffix)] not in bases]
    return df.drop(*gone)


def feature_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    exclude = set(exclude)
    return [c for c in df.columns if c not in exclude]


def schema_difference(left: DataFrame, right: DataFrame) -> list[str]:
    """What keeps two feature tables from having the same columns in the same order."""
    a = {f.name: f.dataType.simpleString() for f in left.schema.fields}
    b = {f.name: f.dataType.simpleString() for f in right.schema.fields}
    out = [f"only left: {c}" for c in a if c not in b] + [f"only right: {c}" for c in b if c not in a]
    out += [f"type of {c}: {a[c]} / {b[c]}" for c in a if c in b and a[c] != b[c]]
    if not out and list(a) != list(b):
        out.append("order of columns differs")
    return out


def require_parity(left: DataFrame, right: DataFrame) -> None:
    problems = schema_difference(left, right)
    if problems:
        raise ValueError("feature tables differ: " + "; ".join(problems))
