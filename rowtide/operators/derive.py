"""Features computed from one entity's aggregated row, as SQL text like the blocks."""

from __future__ import annotations

from collections.abc import Iterable

from rowtide.functions.text import filled, name, ratio
from rowtide.operators.blocks import Block
from rowtide.spec import FeatureOptions, PanelSpec


def family_sum(columns: Iterable[str]) -> str:
    """Horizontal sum, missing values count as 0."""
    return "(" + " + ".join(["0D", *(f"coalesce({name(c)}, 0D)" for c in columns)]) + ")"


def family_nets(spec: PanelSpec, options: FeatureOptions) -> Block:
    return {
        out: f"{family_sum(spec.families[a])} - {family_sum(spec.families[b])}"
        for out, a, b in options.family_nets
    }


def after_pay(options: FeatureOptions) -> Block:
    return {f"{base}-{pay}": f"{name(base)} - {name(pay)}" for base, pay in options.after_pay}


def _last(c: str, options: FeatureOptions) -> str:
    value = f"CAST({name(c)} AS DOUBLE)"
    return f"({filled(value, options.fill)})" if options.impute == "early" else name(c)


def range_versus_last(spec: PanelSpec, options: FeatureOptions) -> Block:
    out: Block = {}
    for c in (c for f in options.range_lag_families for c in spec.families[f]):
        for stat in ("min", "max"):
            if options.wants(stat, c):
                extreme = name(f"{c}_{stat}")
                out[f"{c}_{stat}_lag_sub"] = f"{extreme} - {_last(c, options)}"
                out[f"{c}_{stat}_lag_div"] = ratio(extreme, _last(c, options))
    return out


def fixed_ratios(options: FeatureOptions) -> Block:
    return {out: ratio(_last(a, options), _last(b, options)) for out, a, b in options.fixed_ratios}


def versus_mean(spec: PanelSpec, options: FeatureOptions) -> Block:
    sub, div = ("-mean", "-div-mean") if options.mean_style == "dash" else ("_lag_mean", "_div_mean")
    out: Block = {}
    for c in spec.numeric:
        last = _last(c, options)
        mean, low, high, std = (name(f"{c}_{s}") for s in ("mean", "min", "max", "std"))
        if options.versus_mean and options.wants("mean", c):
            out[f"{c}{sub}"] = f"{last} - {mean}"
            out[f"{c}{div}"] = ratio(last, mean)
        if options.min_vs_max and options.wants("min", c) and options.wants("max", c):
            out[f"{c}_min_div_max"] = ratio(low, high)
            out[f"{c}_min-max"] = f"{low} - {high}"
        if options.zscore and options.wants("mean", c) and options.wants("std", c):
            out[f"{c}-zscore"] = ratio(f"{last} - {mean}", std)
    return out


def pay_ratios(options: FeatureOptions) -> Block:
    """Spend minus payment over balance: of the last row, and of the entity's sums."""
    out: Block = {}
    for s, p, b in options.pay_ratios:
        net = f"({name(s)} - {name(p)})"
        if options.impute == "early":
            net = filled(net, options.fill)
        out[f"{s}-{p}div{b}"] = ratio(net, _last(b, options))
    for s, p, b in options.pay_sum_ratios:
        net = f"{name(f'{s}_sum')} - {name(f'{p}_sum')}"
        out[f"{s}s-{p}s_d_{b}"] = ratio(net, _last(b, options))
    return out
