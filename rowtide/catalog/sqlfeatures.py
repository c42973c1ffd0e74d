"""SQL text of the feature blocks, written against rows with ``rn`` and ``n``."""

from __future__ import annotations

from rowtide.catalog.fixtures import numbered_sql
from rowtide.spec import FeatureOptions, PanelSpec


def at(c: str, place: str) -> str:
    return f"max({c}) FILTER (WHERE {place})"


def first(c: str) -> str:
    return f"arg_min({c}, rn) FILTER (WHERE {c} IS NOT NULL)"


def last(c: str) -> str:
    return f"arg_max({c}, rn) FILTER (WHERE {c} IS NOT NULL)"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


MIDDLE = "rn = floor((n + 1) / 2.0) + 1"
MIDDLE_ANY = f"(n = 1 OR {MIDDLE})"


def feature_sql(spec: PanelSpec, o: FeatureOptions) -> str:
    """The wide row for the options the catalogue uses, unrounded, before filling."""
    q, agg = '"{}"'.format, {}
    for c in (*spec.numeric, *spec.categorical):
        agg[c] = at(c, "rn = n")
    for c in spec.numeric:
        for stat, fn in (("mean", "avg"), ("min", "min"), ("max", "max"), ("std", "stddev_samp")):
            if o.wants(stat, c):
                agg[f"{c}_{stat}"] = f"{fn}({c})"
    for c in spec.family_columns:
        agg[f"{c}_sum"] = f"coalesce(sum({c}), 0)"
    if o.first:
        agg |= {f"{c}_first": first(c) for c in spec.numeric}
    if o.last_lag:
        for c in spec.numeric:
            agg[f"{c}_last_lag_sub"] = f"{last(c)} - {first(c)}"
            agg[f"{c}_last_lag_div"] = div(last(c), first(c))
    agg |= {f"{c}_diff1": f"{at(c, 'rn = n')} - {at(c, 'rn = n - 1')}" for c in o.diff1}
    diffed = spec.family_columns or spec.numeric
    for p in o.diffs:
        agg |= {f"{c}_diff{p}": f"{at(c, 'rn = n')} - {at(c, f'rn = n - {p}')}" for c in diffed}
    for p in o.pct_changes:
        agg |= {f"{c}_pct_chg{p}": f"{div(at(c, 'rn = n'), at(c, f'rn = n - {p}'))} - 1" for c in diffed}
    agg |= {f"{c}_mid": at(c, MIDDLE_ANY) for c in o.middle}
    agg |= {f"{c}_mid_gt2": at(c, f"n > 2 AND {MIDDLE}") for c in o.middle_gt2}
    if o.calendar:
        t = spec.time
        agg[f"{t}_Count"] = f"count({t})"
        agg[f"{t}_Sun_Count"] = f"nullif(count(*) FILTER (WHERE isodow({t}) = 7), 0)"
        agg[f"{t}_wk_std"] = f"stddev_samp(weekofyear({t}))"
    if o.category_stats:
        for c in spec.categorical:
            agg[f"{c}_count"] = f"count({c})"
            agg[f"{c}_nunique"] = f"count(DISTINCT {c})"
            if o.wants("std", c):
                agg[f"{c}_std"] = f"stddev_samp({c})"
            agg[f"{c}_first"] = first(c)
    agg |= {f"{c}_mean": f"avg({c})" for c in o.category_means}

    early = o.impute == "early"

    def now(c: str) -> str:
        return f"coalesce({q(c)}, {o.fill})" if early else q(c)

    out = {c: q(c) for c in agg if o.keep_sums or c not in {f"{x}_sum" for x in spec.family_columns}}
    for name, a, b in o.family_nets:
        plus = " + ".join(f"coalesce({q(c)}, 0)" for c in spec.families[a])
        minus = " + ".join(f"coalesce({q(c)}, 0)" for c in spec.families[b])
        out[name] = f"({plus}) - ({minus})"
    out |= {f"{b}-{p}": f"{q(b)} - {q(p)}" for b, p in o.after_pay}
    for c in (c for f in o.range_lag_families for c in spec.families[f]):
        for stat in ("min", "max"):
            if o.wants(stat, c):
                s = q(f"{c}_{stat}")
                out[f"{c}_{stat}_lag_sub"] = f"{s} - {now(c)}"
                out[f"{c}_{stat}_lag_div"] = div(s, now(c))
    out |= {name: div(now(a), now(b)) for name, a, b in o.fixed_ratios}
    sub, quot = ("-mean", "-div-mean") if o.mean_style == "dash" else ("_lag_mean", "_div_mean")
    for c in spec.numeric:
        mean, low, high, std = (q(f"{c}_{s}") for s in ("mean", "min", "max", "std"))
        if o.versus_mean and o.wants("mean", c):
            out[f"{c}{sub}"] = f"{now(c)} - {mean}"
            out[f"{c}{quot}"] = div(now(c), mean)
        if o.min_vs_max and o.wants("min", c) and o.wants("max", c):
            out[f"{c}_min_div_max"] = div(low, high)
            out[f"{c}_min-max"] = f"{low} - {high}"
        if o.zscore:
            out[f"{c}-zscore"] = div(f"({now(c)} - {mean})", std)
    for s, p, b in o.pay_ratios:
        net = f"({q(s)} - {q(p)})"
        out[f"{s}-{p}div{b}"] = div(f"coalesce({net}, {o.fill})" if early else net, now(b))
    for s, p, b in o.pay_sum_ratios:
        out[f"{s}s-{p}s_d_{b}"] = div(f"({q(f'{s}_sum')} - {q(f'{p}_sum')})", now(b))

    rows = numbered_sql(spec)
    if o.quantise:
        cleaned = ", ".join(f"round_even({c} * 100, 0) / 100 AS {c}" for c in spec.numeric)
        rows = f"SELECT * REPLACE ({cleaned}) FROM ({rows})"
    inner = ", ".join(f"{e} AS {q(c)}" for c, e in agg.items())
    outer = ", ".join(f"{e} AS {q(c)}" for c, e in out.items())
    return f"SELECT {spec.entity}, {outer} FROM (SELECT {spec.entity}, {inner} FROM ({rows}) GROUP BY {spec.entity})"


def filled_sql(body: str, key: str, fill: int = -1, digits: int = 6) -> str:
    """Fill missing values and round; every feature as DOUBLE."""
    return (
        f"SELECT {key}, round(CAST(coalesce(COLUMNS(* EXCLUDE ({key})), {fill}) AS DOUBLE), {digits}) "
        f"FROM ({body})"
    )
