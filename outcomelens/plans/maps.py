"""Model metrics of several runs to map layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelens.constants import DISTRICT_KEY_CANDIDATES, GROUP_LAYERS, REGION_KEY_CANDIDATES
from outcomelens.operators.columns import normalize_name
from outcomelens.operators.compare import stack_tables
from outcomelens.operators.regions import (
    discover_property_key,
    feature_columns,
    grouped_layers,
    harmonise_metrics,
    metric_layers,
    observed_layer,
)
from outcomelens.sources.writers import write_ordered_csv, write_parquet

_CANDIDATES = {"District": DISTRICT_KEY_CANDIDATES, "Community Area": REGION_KEY_CANDIDATES}


def combine_models(tables: Mapping[str, DataFrame], out_dir: str | None = None) -> DataFrame:
    """Metric tables by model name, harmonised and stacked.

    With ``out_dir`` the combined table is written there as ordered CSV.
    """
    combined = stack_tables([harmonise_metrics(df, model) for model, df in tables.items()])
    if out_dir:
        path = f"{out_dir.rstrip('/')}/combined_by_community_metrics"
        write_ordered_csv(combined, path, [F.asc("ModelType"), F.asc("community_area")])
    return combined


def group_maps(
    shapes: Mapping[str, DataFrame], tables: Mapping[str, Mapping[str, DataFrame]], out_dir: str | None = None
) -> dict[str, DataFrame]:
    """The layers of every region key that has shapes and metric tables, by key.

    ``shapes``: region features by key (``District``, ``Community Area``); ``tables``: by the same key, the
    per-group metric tables of each model. With ``out_dir`` a key's layers are written as
    Parquet, one folder per model and metric.
    """
    layers = {}
    for key, metrics in GROUP_LAYERS.items():
        if key not in shapes or not tables.get(key):
            continue
        number = discover_property_key(shapes[key], _CANDIDATES[key])
        named = feature_columns(shapes[key], {"region": number})
        layers[key] = grouped_layers(named, tables[key], "region", key, metrics)
        if out_dir:
            path = f"{out_dir.rstrip('/')}/layers_by_{normalize_name(key)}"
            write_parquet(layers[key], path, ["ModelType", "metric"])
    return layers


def map_layers(features: DataFrame, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The error layers of every model, and the observed-rate layer where reported."""
    key = discover_property_key(features)
    named = feature_columns(features, {"area": key, "community": "community"})
    combined = combine_models(tables)
    layers = {"errors": metric_layers(named, combined, "area")}
    if "Arrest_Rate_true" in combined.columns and "n_obs" in combined.columns:
        layers["observed"] = observed_layer(named, combined, "area")
    return layers
