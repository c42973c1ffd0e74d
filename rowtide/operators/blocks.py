"""Feature blocks: named aggregate expressions over the rows of one entity.

A block is a dict of output name to aggregate expression (SQL text, which is
far cheaper to hand to Spark than thousands of Column calls when rows are
wide). Blocks are merged into a single ``groupBy``, so adding one never adds a
shuffle. Positional blocks read ``__rn`` (position from 1) and ``__n`` (rows of
the entity). Every aggregate can be combined from partial results, so split
entities need nothing special.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.functions.text import name, quoted, ratio
from rowtide.operators.positions import N, RN
from rowtide.session import compiled, materialise, release
from rowtide.spec import FeatureOptions

Block = dict[str, str]

_STATS = {"mean": "avg", "min": "min", "max": "max", "std": "stddev_samp"}


def merge(*blocks: Block) -> Block:
    """Union of blocks; two blocks may not produce the same name."""
    out: Block = {}
    for block in blocks:
        again = out.keys() & block.keys()
        if again:
            raise ValueError(f"duplicate output columns: {sorted(again)}")
        out |= block
    return out


def aggregate(df: DataFrame, key: str, *blocks: Block) -> DataFrame:
    """One row per key with every expression of the blocks."""
    return df.groupBy(key).agg(*[F.expr(f"{e} AS {name(n)}") for n, e in merge(*blocks).items()])


# Fields that a generated-code aggregate may carry (spark.sql.codegen.maxFields is 100), and what an aggregate
# of each kind holds until it is finished.
_FIELDS = 90
_HELD = {"avg": 2, "stddev_samp": 3, "kurtosis": 5, "min_by": 2, "max_by": 2}
_CALL = re.compile(r"\b(\w+)\(")
_AGGREGATES = {"avg", "min", "max", "sum", "stddev_samp", "kurtosis", "min_by", "max_by", "count", "count_if", "bit_or"}
_NAMED = re.compile(r"`((?:[^`]|``)+)`")
_SLOT = "`@`"


def _fields(expressions: Iterable[str]) -> int:
    """Fields that aggregates of these expressions hold, at most."""
    calls = [fn for e in expressions for fn in _CALL.findall(e) if fn in _AGGREGATES]
    return sum(_HELD.get(fn, 1) for fn in calls)


_COMMON = 8  # an aggregate that fewer than one in so many columns gets is left to the common pass


def _alike(block: Block, kinds: Mapping[str, str], least: int) -> list[tuple[list[str], dict[str, dict[str, str]]]]:
    """Columns of one type and the aggregates they get: (expressions with a slot for the column, {column: {expression: output}}).

    A column takes part with all expressions that enough columns of its type have; what is not
    asked of a column is not shown. Expressions over several columns are in none.
    """
    by_kind: dict[str, dict[str, dict[str, str]]] = {}
    for out, e in block.items():
        used = {c.replace("``", "`") for c in _NAMED.findall(e)}
        if len(used) == 1:
            (c,) = used
            by_kind.setdefault(kinds[c], {}).setdefault(c, {})[e.replace(name(c), _SLOT)] = out
    groups = []
    for columns in by_kind.values():
        common = _common(columns)
        # Columns that get more than the common ones are a group of their own, if there are enough of them.
        more = {c: found for c, found in columns.items() if found.keys() - set(common)}
        plain = {c: found for c, found in columns.items() if c not in more}
        apart = all(len(_common(part)) * len(part) >= least for part in (plain, more))
        groups += [(_common(part), part) for part in ((plain, more) if apart else (columns,))]
    return [(s, {c: own for c, found in part.items() if (own := {e: o for e, o in found.items() if e in s})}) for s, part in groups]


def _common(columns: Mapping[str, Mapping[str, str]]) -> list[str]:
    """Expressions that enough of the columns have."""
    times = Counter(e for found in columns.values() for e in found)
    return [e for e, n in times.items() if n * _COMMON >= len(columns)]


def aggregate_wide(df: DataFrame, key: str, *blocks: Block, least: int = 200, at_once: int | None = None) -> DataFrame:
    """``aggregate`` for rows of many columns: the same result, in generated code.

    An aggregate of hundreds of columns leaves generated code. Columns that get the same aggregates
    are therefore laid out as several short rows (key, part, a few columns), which are aggregated by
    (key, part); what comes out is a few rows per key, put side by side again as one list. Rows that are
    partitioned by ``key`` stay where they are throughout. Everything else is aggregated as before, and
    joined once. Fewer than ``least`` expressions are not worth it.

    ``at_once``: more columns than that are shuffled in turns of about so many. What a turn gives is stored, and its shuffle
    files go before the next one, so the disk that is needed follows the columns of a turn, not all of them. So is what
    is aggregated as before: wide rows are laid out in code that the JVM compiles (``session.compiled``).
    """
    block = merge(*blocks)
    kinds = dict(df.dtypes)
    wide = [g for g in _alike(block, kinds, least) if len(g[0]) * len(g[1]) >= least]
    if not wide:
        return aggregate(df, key, block)
    rest = dict(block)
    in_turns = at_once is not None and sum(len(outputs) for _, outputs in wide) > at_once
    out = None
    for shapes, outputs in wide:
        columns = list(outputs)
        per_part = max(1, _FIELDS // max(1, _fields(shapes)))
        turns = -(-len(columns) // max(1, at_once + at_once // 10)) if in_turns else 1
        per_turn = -(-len(columns) // turns // per_part) * per_part
        for begin in range(0, len(columns), per_turn):
            side = _in_parts(df, key, shapes, {c: outputs[c] for c in columns[begin : begin + per_turn]}, per_part, kinds[columns[0]])
            side = _turn(side) if in_turns else side
            out = side if out is None else _beside(out, side, key)
        for found in outputs.values():
            for o in found.values():
                del rest[o]
    if rest:
        side = aggregate(df, key, rest)
        out = _beside(out, _turn(side) if in_turns else side, key)
    return out.selectExpr(name(key), *[name(o) for o in block])


def _turn(df: DataFrame) -> DataFrame:
    """What a turn gives, stored; its shuffle files go."""
    spark = df.sparkSession
    with compiled(spark):
        df = materialise(df, "wide-turn")
    release(spark)
    return df


def _in_parts(
    df: DataFrame, key: str, shapes: list[str], outputs: Mapping[str, Mapping[str, str]], per_part: int, kind: str
) -> DataFrame:
    """Key and the outputs of the columns of ``outputs``, aggregated as short rows of ``per_part`` columns each."""
    columns = list(outputs)
    parts = [columns[j : j + per_part] for j in range(0, len(columns), per_part)]
    rows = []
    for at, part in enumerate(parts):
        cells = [f"{name(c)} AS v{j}" for j, c in enumerate(part)]
        cells += [f"CAST(NULL AS {kind}) AS v{j}" for j in range(len(part), per_part)]
        rows.append(f"struct({at} AS __part, {', '.join(cells)})")
    laid = df.selectExpr(name(key), RN, N, f"inline(array({', '.join(rows)}))")
    made = [f"{e.replace(_SLOT, f'v{j}')} AS o{j}_{k}" for j in range(per_part) for k, e in enumerate(shapes)]
    short = laid.groupBy(key, "__part").agg(*[F.expr(e) for e in made])
    names = ", ".join(f"o{j}_{k}" for j in range(per_part) for k in range(len(shapes)))
    again = short.groupBy(key).agg(F.expr(f"array_sort(collect_list(struct(__part, {names}))) AS __parts"))
    picked = []
    for n, c in enumerate(columns):
        at, j = divmod(n, per_part)
        picked += [f"__parts[{at}].o{j}_{k} AS {name(outputs[c][e])}" for k, e in enumerate(shapes) if e in outputs[c]]
    return again.selectExpr(name(key), *picked)


def _beside(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Both have one row for each key, a missing key included."""
    renamed = right.withColumnRenamed(key, "__key")
    return left.join(renamed, F.col(f"`{key}`").eqNullSafe(F.col("__key"))).drop("__key")


def _at(c: str, place: str) -> str:
    return f"max(CASE WHEN {place} THEN {name(c)} END)"


def _back(steps: int) -> str:
    return f"{RN} = {N} - {steps}"


def _valued(fn: str, c: str) -> str:
    return f"{fn}({name(c)}, {RN}) FILTER (WHERE {name(c)} IS NOT NULL)"


def statistics(columns: Iterable[str], options: FeatureOptions) -> Block:
    return {
        f"{c}_{s}": f"{_STATS[s]}({name(c)})"
        for c in columns
        for s in options.stats
        if options.wants(s, c)
    }


def sums(columns: Iterable[str]) -> Block:
    """Missing values are skipped; an all-missing column sums to 0."""
    return {f"{c}_sum": f"coalesce(sum({name(c)}), 0D)" for c in columns}


def last_row(columns: Iterable[str]) -> Block:
    """The last row as it is, missing values included."""
    return {c: _at(c, _back(0)) for c in columns}


def first_values(columns: Iterable[str]) -> Block:
    """First non-missing value."""
    return {f"{c}_first": _valued("min_by", c) for c in columns}


def last_values(columns: Iterable[str]) -> Block:
    """Last non-missing value."""
    return {f"{c}_last": _valued("max_by", c) for c in columns}


def last_versus_first(columns: Iterable[str]) -> Block:
    out: Block = {}
    for c in columns:
        last, first = _valued("max_by", c), _valued("min_by", c)
        out[f"{c}_last_lag_sub"] = f"{last} - {first}"
        out[f"{c}_last_lag_div"] = ratio(last, first)
    return out


def differences(columns: Iterable[str], period: int) -> Block:
    """Last row minus the row ``period`` earlier; NULL for shorter histories."""
    return {f"{c}_diff{period}": f"{_at(c, _back(0))} - {_at(c, _back(period))}" for c in columns}


def percent_changes(columns: Iterable[str], period: int) -> Block:
    return {
        f"{c}_pct_chg{period}": f"{ratio(_at(c, _back(0)), _at(c, _back(period)))} - 1D"
        for c in columns
    }


_MIDDLE = f"({N} + 1) div 2 + 1"


def middle(columns: Iterable[str]) -> Block:
    """Middle row, the only row for one-row entities."""
    return {f"{c}_mid": _at(c, f"{RN} = least({_MIDDLE}, {N})") for c in columns}


def middle_gt2(columns: Iterable[str]) -> Block:
    """Middle row of entities with more than two rows."""
    return {f"{c}_mid_gt2": _at(c, f"{N} > 2 AND {RN} = {_MIDDLE}") for c in columns}


MAX_CODES = 1024
_WORD = 64
Codes = Mapping[str, range | list[str]]


def category_codes(df: DataFrame, columns: Iterable[str]) -> Codes:
    """Which codes each category column holds: a range for integers, else the listed values.

    Columns with more than ``MAX_CODES`` are absent. One pass takes the extremes of
    integers and an estimate of the number of codes; columns whose integers are far
    apart, and others, are listed in a second pass if the estimate is low. Tasks
    combine the codes they see, so what is gathered stays near ``MAX_CODES`` a column.
    """
    columns = list(columns)
    if not columns:
        return {}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    whole = [c for c in columns if isinstance(kinds[c], T.IntegralType)]
    ends = df.agg(
        *[F.approx_count_distinct(c) for c in columns],
        *[F.min(c) for c in whole],
        *[F.max(c) for c in whole],
    ).first()
    about, extremes = dict(zip(columns, ends, strict=False)), ends[len(columns) :]
    out: dict[str, range | list[str]] = {}
    for c, low, high in zip(whole, extremes[: len(whole)], extremes[len(whole) :], strict=True):
        if low is None or high - low < MAX_CODES:
            out[c] = range(low or 0, (high or 0) + 1)
    listed = [c for c in columns if c not in out and about[c] <= 1.2 * MAX_CODES]
    if listed:
        found = df.agg(*[F.collect_set(F.col(c).cast("string")) for c in listed]).first()
        out |= {c: sorted(v) for c, v in zip(listed, found, strict=True) if len(v) <= MAX_CODES}
    return out


def _distinct(c: str, codes: range | list[str] | None, kind: str) -> str:
    """Exact distinct count. Known codes become bits of a few words, so nothing is gathered."""
    if codes is None:
        return f"count(DISTINCT {name(c)})"
    if not codes:
        return "0L * count(*)"
    if isinstance(codes, range):
        place = f"(CAST({name(c)} AS BIGINT) - ({codes.start}))"
    else:
        listed = ", ".join(f"CAST({quoted(v)} AS {kind})" for v in codes)
        place = f"(array_position(array({listed}), {name(c)}) - 1)"
    words = []
    for word in range(0, len(codes), _WORD):
        bit = f"shiftleft(1L, CAST({place} - {word} AS INT))"
        if len(codes) > _WORD:
            bit = f"CASE WHEN {place} >= {word} AND {place} < {word + _WORD} THEN {bit} END"
        words.append(f"coalesce(bit_count(bit_or({bit})), 0)")
    return f"CAST({' + '.join(words)} AS BIGINT)"


def categories(
    columns: Iterable[str],
    options: FeatureOptions,
    codes: Codes | None = None,
    kinds: Mapping[str, str] | None = None,
) -> Block:
    """Count, distinct count, spread and first value of numeric category codes.

    ``codes`` (from ``category_codes``) and ``kinds`` (column types) keep the
    distinct counts in the same generated-code aggregate as everything else;
    without them they take an extra expansion of the rows.
    """
    out: Block = {}
    codes, kinds = codes or {}, kinds or {}
    for c in columns:
        out[f"{c}_count"] = f"count({name(c)})"
        out[f"{c}_nunique"] = _distinct(c, codes.get(c), kinds.get(c, "string"))
        if options.wants("std", c):
            out[f"{c}_std"] = f"stddev_samp({name(c)})"
    return merge(out, first_values(columns))


def means(columns: Iterable[str]) -> Block:
    return {f"{c}_mean": f"avg({name(c)})" for c in columns}


def calendar_counts(time: str) -> Block:
    """Dated rows, Sundays (NULL when there is none) and spread of the ISO week."""
    t = name(time)
    return {
        f"{time}_Count": f"count({t})",
        f"{time}_Sun_Count": f"nullif(count_if(weekday({t}) = 6), 0L)",
        f"{time}_wk_std": f"stddev_samp(weekofyear({t}))",
    }


def kurtoses(columns: Iterable[str]) -> Block:
    """Unbiased excess kurtosis from Spark's population form; NULL below four values."""
    out: Block = {}
    for c in columns:
        n = f"CAST(count({name(c)}) AS DOUBLE)"
        factor = f"try_divide({n} - 1, ({n} - 2) * ({n} - 3))"
        unbiased = f"{factor} * (({n} + 1) * kurtosis({name(c)}) + 6)"
        out[f"{c}_kurt"] = f"CASE WHEN {n} >= 4 THEN {unbiased} END"
    return out


def mean_abs_deviations(columns: Iterable[str]) -> Block:
    """Mean absolute distance from the entity mean, which rows carry as ``__mean_{c}``."""
    return {f"{c}_mad": f"avg(abs({name(c)} - {name(f'__mean_{c}')}))" for c in columns}


def entity_means(columns: Iterable[str]) -> Block:
    return {f"__mean_{c}": f"avg({name(c)})" for c in columns}
