"""Panel features, encoders, folds, metrics and scoring as Spark DataFrame plans."""

from rowtide.spec import FeatureOptions, PanelSpec, families_by_prefix

__all__ = ["FeatureOptions", "PanelSpec", "families_by_prefix"]
