"""Inputs of the network: early-filled feature row with one-hot categories; ranks are fitted per fold."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rowtide.operators.encode import apply_one_hot, fit_one_hot, load_categories, save_categories
from rowtide.plans.feature_row import feature_row
from rowtide.session import materialise
from rowtide.sources.cache import finished
from rowtide.spec import FeatureOptions, PanelSpec


def network_row(df: DataFrame, spec: PanelSpec, options: FeatureOptions, categories: str) -> DataFrame:
    """One row per entity; the last categories become flags.

    The first call fits the categories and stores them at the path ``categories``;
    later calls (for a test panel) use the stored ones.
    """
    if options.impute != "early":
        raise ValueError("the network takes early-filled rows")
    rows = materialise(feature_row(df, spec, options), "network-row")
    if not finished(df.sparkSession, categories):
        save_categories(fit_one_hot(rows, spec.categorical), categories)
    return apply_one_hot(rows, load_categories(df.sparkSession, categories), list(spec.categorical))
