"""A feature table that takes new panel rows without reading the old ones again.

Each entity keeps a state from which its feature row follows, and two states of an entity merge into the
state of all their rows: counts, means and sums of squared deviations, extremes, the first and last
value with the order they have, the codes seen, and the last few rows for differences. A load
computes the state of its new rows in one aggregation, merges it with the stored one by one join, and writes the
next version. Rows may come in any order.

A load has a name. The manifest (one small table a load) says which loads a version holds: a load that is in it is
skipped, one that was stopped before its manifest was written starts again on the version before. Old versions stay until
``forget`` removes them.

Not to be had this way, as they need all rows of an entity at once: middle rows, positions, mean
absolute deviations and kurtoses. They are refused.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.text import name, ratio
from rowtide.operators.positions import RN, N, with_ordinals
from rowtide.plans.feature_row import finished_row, quantised
from rowtide.session import discard
from rowtide.sources.cache import finished, require_same
from rowtide.spec import FeatureOptions, PanelSpec

_MANIFEST = "version int, load string, rows bigint"


def _refuse(options: FeatureOptions) -> None:
    asked = [o for o in ("middle", "middle_gt2", "mean_abs_dev", "kurtosis", "positions") if getattr(options, o)]
    asked += ["positions"] if options.positions is None else []
    if asked:
        raise ValueError(f"{asked} need all rows of an entity at once; switch them off for a table that grows")


@dataclass(frozen=True)
class Layout:
    """Names and expressions of a state."""

    spec: PanelSpec
    options: FeatureOptions

    @property
    def order(self) -> str:
        """Missing times first, as when rows are numbered."""
        return "struct(" + ", ".join(name(c) for c in self.spec.order) + ")"

    @property
    def tail(self) -> int:
        """Rows that are kept at the end."""
        lags = [*self.options.diffs, *self.options.pct_changes, *([1] if self.options.diff1 else [])]
        return 1 + max(lags, default=0)

    @property
    def values(self) -> dict[str, str]:
        """State column of moments, for each value that has them."""
        out = {c: name(c) for c in (*self.spec.numeric, *self.spec.categorical)}
        if self.options.calendar:
            out[f"week of {self.spec.time}"] = f"weekofyear({name(self.spec.time)})"
        return out

    def moments(self, rows: DataFrame) -> DataFrame:
        """State of rows: one row per entity."""
        spec, parts = self.spec, ["count(*) AS n"]
        for i, (c, e) in enumerate(self.values.items()):
            parts.append(f"struct(count({e}) AS n, avg({e}) AS mean, var_pop({e}) * count({e}) AS m2) AS m{i}")
            if c in spec.numeric:
                parts.append(f"struct(min({e}) AS low, max({e}) AS high) AS e{i}")
            if c in spec.numeric or c in spec.categorical:
                seen = f"FILTER (WHERE {e} IS NOT NULL)"
                parts.append(f"min(struct({self.order} AS at, {e} AS value)) {seen} AS f{i}")
                parts.append(f"max(struct({self.order} AS at, {e} AS value)) {seen} AS l{i}")
            if c in spec.categorical:
                parts.append(f"array_sort(collect_set({e})) AS c{i}")
        t = name(spec.time)
        parts += [f"count({t}) AS dated", f"count_if(weekday({t}) = 6) AS sundays"]
        shown = ", ".join(f"{name(c)} AS {name(c)}" for c in (*spec.numeric, *spec.categorical))
        held = f"struct({self.order} AS at, struct({shown}) AS v)"
        ends = ", ".join(f"max(CASE WHEN {RN} = {N} - {p} THEN {held} END)" for p in range(self.tail))
        parts.append(f"filter(array({ends}), r -> r IS NOT NULL) AS tail")
        return with_ordinals(rows, spec).groupBy(spec.entity).agg(*[F.expr(p) for p in parts])

    def merged(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """The state of all rows of both; an entity may be in one only."""
        spec, key = self.spec, name(self.spec.entity)
        a = old.select(F.col(key).alias("__ka"), F.struct(*[F.col(name(c)) for c in old.columns if c != spec.entity]).alias("a"))
        b = new.select(F.col(key).alias("__kb"), F.struct(*[F.col(name(c)) for c in new.columns if c != spec.entity]).alias("b"))
        both = a.join(b, F.col("__ka").eqNullSafe(F.col("__kb")), "full")
        is_old = "a IS NOT NULL"
        out = [f"CASE WHEN {is_old} THEN __ka ELSE __kb END AS {key}", "coalesce(a.n, 0) + coalesce(b.n, 0) AS n"]
        for i, c in enumerate(self.values):
            x, y = f"a.m{i}", f"b.m{i}"
            n = f"(coalesce({x}.n, 0) + coalesce({y}.n, 0))"
            off = f"({y}.mean - {x}.mean)"
            mean = f"coalesce({x}.mean + {off} * ({y}.n / {n}), {x}.mean, {y}.mean)"
            m2 = f"coalesce({x}.m2 + {y}.m2 + {off} * {off} * ({x}.n * ({y}.n / {n})), {x}.m2, {y}.m2)"
            out.append(f"struct({n} AS n, {mean} AS mean, {m2} AS m2) AS m{i}")
            if c in spec.numeric:
                out.append(f"struct(least(a.e{i}.low, b.e{i}.low) AS low, greatest(a.e{i}.high, b.e{i}.high) AS high) AS e{i}")
            if c in spec.numeric or c in spec.categorical:
                out += [f"least(a.f{i}, b.f{i}) AS f{i}", f"greatest(a.l{i}, b.l{i}) AS l{i}"]
            if c in spec.categorical:
                out.append(f"array_sort(array_union(coalesce(a.c{i}, array()), coalesce(b.c{i}, array()))) AS c{i}")
        out += [f"coalesce(a.{c}, 0L) + coalesce(b.{c}, 0L) AS {c}" for c in ("dated", "sundays")]
        tails = "concat(coalesce(a.tail, array()), coalesce(b.tail, array()))"
        out.append(f"slice(reverse(array_sort({tails})), 1, {self.tail}) AS tail")
        return both.selectExpr(*out).select(*old.columns)

    def features(self) -> dict[str, str]:
        """The aggregates of ``aggregate_blocks``, in its order, read off a state."""
        spec, o = self.spec, self.options
        place = {c: i for i, c in enumerate(self.values)}
        num, cat = spec.numeric, spec.categorical

        def back(c: str, p: int) -> str:
            return f"get(tail, {p}).v.{name(c)}"

        def std(c: str) -> str:
            m = f"m{place[c]}"
            return f"CASE WHEN {m}.n > 1 THEN sqrt({m}.m2 / ({m}.n - 1)) END"

        out = {c: back(c, 0) for c in (*num, *cat)}
        reads = {"mean": lambda c: f"m{place[c]}.mean", "min": lambda c: f"e{place[c]}.low", "max": lambda c: f"e{place[c]}.high", "std": std}
        out |= {f"{c}_{s}": reads[s](c) for c in num for s in o.stats if o.wants(s, c)}
        out |= {f"{c}_sum": f"coalesce(m{place[c]}.mean * m{place[c]}.n, 0D)" for c in spec.family_columns}
        if o.first:
            out |= {f"{c}_first": f"f{place[c]}.value" for c in num}
        if o.last_lag:
            for c in num:
                last, first = f"l{place[c]}.value", f"f{place[c]}.value"
                out[f"{c}_last_lag_sub"] = f"{last} - {first}"
                out[f"{c}_last_lag_div"] = ratio(last, first)
        out |= {f"{c}_diff1": f"{back(c, 0)} - {back(c, 1)}" for c in o.diff1}
        moved = spec.family_columns or num
        for p in o.diffs:
            out |= {f"{c}_diff{p}": f"{back(c, 0)} - {back(c, p)}" for c in moved}
        for p in o.pct_changes:
            out |= {f"{c}_pct_chg{p}": f"{ratio(back(c, 0), back(c, p))} - 1D" for c in moved}
        if o.calendar:
            t = spec.time
            out |= {f"{t}_Count": "dated", f"{t}_Sun_Count": "nullif(sundays, 0L)", f"{t}_wk_std": std(f"week of {t}")}
        if o.category_stats:
            for c in cat:
                out |= {f"{c}_count": f"m{place[c]}.n", f"{c}_nunique": f"CAST(size(c{place[c]}) AS BIGINT)"}
                if o.wants("std", c):
                    out[f"{c}_std"] = std(c)
            out |= {f"{c}_first": f"f{place[c]}.value" for c in cat}
        return out | {f"{c}_mean": f"m{place[c]}.mean" for c in o.category_means}


class FeatureTable:
    """Feature states in a folder, grown load by load. ``options`` and ``spec`` are fixed with the first load."""

    def __init__(self, spark: SparkSession, folder: str, spec: PanelSpec, options: FeatureOptions) -> None:
        _refuse(options)
        self.spark, self.folder = spark, folder.rstrip("/")
        self.layout = Layout(spec, options)
        require_same(spark, f"{self.folder}/states", f"{spec}:{options}")

    def _manifest(self, version: int) -> str:
        return f"{self.folder}/manifest_{version}"

    def _states(self, version: int) -> str:
        return f"{self.folder}/states_{version}"

    def loads(self) -> list[tuple[int, str, int]]:
        """(version, load, rows) of all loads that are complete, in order."""
        out, version = [], 1
        while finished(self.spark, self._manifest(version)):
            out.append(tuple(self.spark.read.schema(_MANIFEST).parquet(self._manifest(version)).first()))
            version += 1
        return out

    def load(self, rows: DataFrame, load: str) -> bool:
        """Take new panel rows; False if a load of this name is in already."""
        done = self.loads()
        if load in [name_ for _, name_, _ in done]:
            return False
        spec = self.layout.spec
        rows = rows.select(*[F.col(name(c)) for c in spec.columns])
        if self.layout.options.quantise:
            rows = quantised(rows, spec)
        version, states = len(done) + 1, self.layout.moments(rows)
        if done:
            states = self.layout.merged(self.spark.read.parquet(self._states(len(done))), states)
        states.write.mode("overwrite").parquet(self._states(version))
        total = self.spark.read.parquet(self._states(version)).agg(F.sum("n")).first()[0] or 0
        row = [(version, load, total - sum(n for _, _, n in done))]
        self.spark.createDataFrame(row, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(self._manifest(version))
        return True

    def features(self) -> DataFrame:
        """One feature row per entity, as ``feature_row`` gives for all rows loaded so far."""
        done = self.loads()
        if not done:
            raise ValueError("nothing has been loaded yet")
        spec, options = self.layout.spec, self.layout.options
        reads = self.layout.features()
        states = self.spark.read.parquet(self._states(len(done)))
        wide = states.selectExpr(name(spec.entity), *[f"{e} AS {name(c)}" for c, e in reads.items()])
        return finished_row(wide, list(reads), spec, options)

    def forget(self, keep: int = 1) -> Sequence[int]:
        """Remove the states of all versions but the last ``keep``; which ones went."""
        gone = [v for v, _, _ in self.loads()][: -keep or None]
        for version in gone:
            discard(self.spark, self._states(version))
        return gone
