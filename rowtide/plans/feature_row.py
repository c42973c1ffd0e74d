"""The panel reduced to one wide row per entity, in one shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.functions.text import name
from rowtide.operators import blocks, derive
from rowtide.operators.columns import cast_to, fill_missing, narrow, stored_types
from rowtide.operators.positions import (
    longest_history,
    position_columns,
    with_ordinals,
    with_time_ranks,
)
from rowtide.session import materialise
from rowtide.spec import FeatureOptions, PanelSpec

_AT_ONCE = 50  # columns of a wide panel that one shuffle carries


def quantised(df: DataFrame, spec: PanelSpec) -> DataFrame:
    num = set(spec.numeric)
    return df.selectExpr(
        *[f"rint({name(c)} * 100D) / 100D AS {name(c)}" if c in num else name(c) for c in df.columns]
    )


def aggregate_blocks(df: DataFrame, spec: PanelSpec, options: FeatureOptions) -> blocks.Block:
    """Every aggregate the options ask for; ``df`` is only used to list category codes."""
    num, cat = spec.numeric, spec.categorical
    parts = [
        blocks.last_row([*num, *cat]),
        blocks.statistics(num, options),
        blocks.sums(spec.family_columns),
    ]
    if options.first:
        parts.append(blocks.first_values(num))
    if options.last_lag:
        parts.append(blocks.last_versus_first(num))
    if options.diff1:
        parts.append(blocks.differences(options.diff1, 1))
    diff_columns = spec.family_columns or num
    parts += [blocks.differences(diff_columns, p) for p in options.diffs]
    parts += [blocks.percent_changes(diff_columns, p) for p in options.pct_changes]
    parts += [blocks.middle(options.middle), blocks.middle_gt2(options.middle_gt2)]
    if options.calendar:
        parts.append(blocks.calendar_counts(spec.time))
    if options.category_stats and cat:
        codes = blocks.category_codes(df, cat)
        parts.append(blocks.categories(cat, options, codes, dict(df.dtypes)))
    parts.append(blocks.means(options.category_means))
    parts += [blocks.kurtoses(options.kurtosis), blocks.mean_abs_deviations(options.mean_abs_dev)]
    parts.append(position_columns(list(cat), options.positions))
    return blocks.merge(*parts)


def feature_row(df: DataFrame, spec: PanelSpec, options: FeatureOptions, types: str | None = None) -> DataFrame:
    """One row per entity: last values, aggregates, ratios; missing values filled.

    ``types``: where the types of a narrowed row are stored. The first table decides them, later ones (a test
    panel, a chunk) take them, so that all have the same.
    """
    rows = df.select(*spec.columns)
    if options.quantise:
        rows = quantised(rows, spec)
    if options.positions is None:
        options = options.with_(positions=longest_history(rows, spec))
    aggregates = aggregate_blocks(rows, spec, options)
    if options.positions:
        rows = with_time_ranks(rows, spec)
    if options.mean_abs_dev or not options.positions:
        rows = with_ordinals(
            rows.select(*spec.columns, *(["statement"] if options.positions else [])),
            spec,
            **{n: F.expr(e) for n, e in blocks.entity_means(options.mean_abs_dev).items()},
        )
    wide = blocks.aggregate_wide(rows, spec.entity, aggregates, at_once=_AT_ONCE)
    return finished_row(wide, list(aggregates), spec, options, types)


def finished_row(wide: DataFrame, aggregates: list[str], spec: PanelSpec, options: FeatureOptions, types: str | None = None) -> DataFrame:
    """Ratios and differences of aggregates, missing values filled; ``wide`` has one row per entity."""
    derived = blocks.merge(
        derive.family_nets(spec, options),
        derive.after_pay(options),
        derive.range_versus_last(spec, options),
        derive.fixed_ratios(options),
        derive.versus_mean(spec, options),
        derive.pay_ratios(options),
    )
    clash = derived.keys() & set(aggregates)
    if clash:
        raise ValueError(f"duplicate output columns: {sorted(clash)}")
    sums = {f"{c}_sum" for c in spec.family_columns}
    kept = [c for c in aggregates if options.keep_sums or c not in sums]
    out = wide.selectExpr(
        name(spec.entity),
        *[name(c) for c in kept],
        *[f"{e} AS {name(n)}" for n, e in derived.items()],
    )
    out = fill_missing(out, options.fill, skip=[spec.entity])
    if options.narrow:
        out = materialise(out, "feature-row")
        out = cast_to(out, stored_types(out, types, [spec.entity])) if types else narrow(out, skip=[spec.entity])
    return out


def attach(features: DataFrame, side: DataFrame, key: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """Left join a per-entity table (labels, precomputed features); names may not collide."""
    side = side.drop(*drop)
    again = (set(features.columns) & set(side.columns)) - {key}
    if again:
        raise ValueError(f"duplicate output columns: {sorted(again)}")
    return features.join(side, key, "left")
