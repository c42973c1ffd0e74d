"""What a panel looks like and which features to derive from it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

Pairs = tuple[tuple[str, str], ...]
Triples = tuple[tuple[str, str, str], ...]


@dataclass(frozen=True)
class PanelSpec:
    """A table with many ordered rows per entity.

    ``order`` starts with the time column and must make rows unique within an
    entity; nothing relies on file order.
    """

    entity: str
    order: tuple[str, ...]
    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    families: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def time(self) -> str:
        return self.order[0]

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys([self.entity, *self.order, *self.numeric, *self.categorical]))

    @property
    def family_columns(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(c for cols in self.families.values() for c in cols))

    @staticmethod
    def from_columns(
        columns: Iterable[str],
        entity: str,
        order: Iterable[str],
        categorical: Iterable[str] = (),
        exclude: Iterable[str] = (),
        families: Mapping[str, tuple[str, ...]] | None = None,
    ) -> PanelSpec:
        """Every column that is not named otherwise is numeric."""
        order, categorical = tuple(order), tuple(categorical)
        taken = {entity, *order, *categorical, *exclude}
        numeric = tuple(c for c in columns if c not in taken)
        return PanelSpec(entity, order, numeric, categorical, families or {})


def families_by_prefix(
    columns: Iterable[str], prefixes: Mapping[str, str], exclude: Iterable[str] = ()
) -> dict[str, tuple[str, ...]]:
    """Column families by name prefix, e.g. ``{"spend": "S_", "balance": "B_"}``."""
    columns, skip = list(columns), set(exclude)
    return {
        name: tuple(c for c in columns if c.startswith(prefix) and c not in skip)
        for name, prefix in prefixes.items()
    }


@dataclass(frozen=True)
class FeatureOptions:
    """Which features to build; anything switched off never enters the plan.

    ``keep`` maps a statistic to the columns it is built for (absent: all).
    ``impute`` is ``"late"`` (ratios see missing values) or ``"early"`` (last
    values are filled before ratios use them).
    """

    stats: tuple[str, ...] = ("mean", "min", "max", "std")
    keep: Mapping[str, frozenset[str]] = field(default_factory=dict)
    first: bool = True
    last_lag: bool = True
    diff1: tuple[str, ...] = ()
    diffs: tuple[int, ...] = ()
    pct_changes: tuple[int, ...] = ()
    middle: tuple[str, ...] = ()
    middle_gt2: tuple[str, ...] = ()
    calendar: bool = True
    category_stats: bool = True
    category_means: tuple[str, ...] = ()
    mean_abs_dev: tuple[str, ...] = ()
    kurtosis: tuple[str, ...] = ()
    positions: int | None = 0  # pivoted reverse positions; None: the longest history
    family_nets: Triples = ()
    after_pay: Pairs = ()
    range_lag_families: tuple[str, ...] = ()
    fixed_ratios: Triples = ()
    versus_mean: bool = True
    min_vs_max: bool = True
    mean_style: str = "dash"
    zscore: bool = False
    pay_ratios: Triples = ()
    pay_sum_ratios: Triples = ()
    keep_sums: bool = False
    impute: str = "late"
    fill: float = -1.0
    quantise: bool = False
    narrow: bool = False

    def __post_init__(self) -> None:
        if self.impute not in ("late", "early"):
            raise ValueError(f"impute must be 'late' or 'early', not {self.impute!r}")
        if self.mean_style not in ("dash", "underscore"):
            raise ValueError(f"mean_style must be 'dash' or 'underscore', not {self.mean_style!r}")

    def wants(self, stat: str, column: str) -> bool:
        return stat in self.stats and (stat not in self.keep or column in self.keep[stat])

    def with_(self, **changes) -> FeatureOptions:
        return replace(self, **changes)

    @staticmethod
    def for_trees(spec: PanelSpec, **changes) -> FeatureOptions:
        """Feature set for boosted trees: missing values stay visible until the end."""
        base = FeatureOptions(
            diff1=spec.numeric,
            diffs=(2,),
            middle=spec.numeric + spec.categorical,
            middle_gt2=spec.family_columns,
            category_means=spec.categorical,
            mean_style="dash",
            impute="late",
            quantise=True,
            narrow=True,
        )
        return base.with_(**changes)

    @staticmethod
    def for_networks(spec: PanelSpec, **changes) -> FeatureOptions:
        """Feature set for neural networks: filled early, no differences."""
        base = FeatureOptions(
            middle_gt2=spec.family_columns,
            category_means=spec.categorical,
            mean_style="underscore",
            impute="early",
            quantise=True,
            narrow=True,
        )
        return base.with_(**changes)
