"""Per-region metrics joined to region features: the data behind the maps.

Region and metric tables are left to Catalyst and AQE, which broadcast a side only
when its size is below the session's threshold. The scales of layers, one row per model and
metric, are always broadcast: streamed, they would put all rows of their layers into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelens.constants import (
    ERROR_RAMP,
    LAYER_RAMPS,
    METRIC_ALIASES,
    MIN_SUPPORT,
    NO_DATA_COLOUR,
    RATE_RAMP,
    REGION_KEY_CANDIDATES,
    REGION_KEY_RANGE,
)
from outcomelens.functions.colour import ramp_column, ramp_fill, ramp_fill_from, two_colour_fill
from outcomelens.functions.parsing import to_whole
from outcomelens.operators.columns import normalize_names, quoted, select_aliased, tag_rows
from outcomelens.operators.compare import first_per_key, metric_range, stack_tables
from outcomelens.session import materialise

# Canonical spelling and type of the harmonised columns.
_CANONICAL = {
    "community_area": ("community_area", "int"),
    "fp_rate": ("FP_rate", "double"),
    "fn_rate": ("FN_rate", "double"),
    "n_obs": ("n_obs", "double"),
    "arrest_rate_true": ("Arrest_Rate_true", "double"),
}
_NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def harmonise_metrics(df: DataFrame, model: str, absent: str = "drop") -> DataFrame:
    """A metric table of any spelling in canonical columns, tagged with its model."""
    plain = normalize_names(df)
    types = {k: kind for k, (_, kind) in _CANONICAL.items()}
    picked = select_aliased(plain, METRIC_ALIASES, types, required=["community_area"], absent=absent)
    named = picked.withColumnsRenamed({k: name for k, (name, _) in _CANONICAL.items()})
    return tag_rows(named, "ModelType", model)


def supported_value(value: Column, n: Column, min_support: int = MIN_SUPPORT, null_n: str = "hide") -> Column:
    """The value where its support suffices, else null.

    ``null_n='show'`` counts unknown support as enough.
    """
    support = F.coalesce(n, F.lit(min_support)) if null_n == "show" else n
    return F.when(support >= F.lit(min_support), value)


def property_column(df: DataFrame, key: str, kind: str = "string") -> Column:
    """A feature property leniently cast; blank or bad text is null."""
    return F.element_at(F.col("properties"), F.lit(key)).try_cast(kind)


def discover_property_key(
    features: DataFrame, candidates: Sequence[str] = REGION_KEY_CANDIDATES
) -> str:
    """The first candidate that any feature carries, in one aggregation."""
    tests = [F.max(F.map_contains_key("properties", c)).alias(f"c{i}") for i, c in enumerate(candidates)]
    found = features.agg(*tests).first()
    for i, name in enumerate(candidates):
        if found[f"c{i}"]:
            return name
    raise ValueError(f"no region key among {tuple(candidates)}")


def discover_column_key(
    df: DataFrame,
    candidates: Sequence[str] = REGION_KEY_CANDIDATES,
    prefix: str = "area",
    key_range: tuple[int, int] = REGION_KEY_RANGE,
) -> str:
    """A candidate column, else a numeric ``area*`` column with every value in range."""
    for name in candidates:
        if name in df.columns:
            return name
    numeric = [c for c, t in df.dtypes if c.lower().startswith(prefix) and t in _NUMERIC_TYPES]
    if numeric:
        low, high = key_range
        outside = [F.count_if(~quoted(c).between(low, high)).alias(f"c{i}") for i, c in enumerate(numeric)]
        counts = df.agg(*outside).first()
        for i, name in enumerate(numeric):
            if counts[f"c{i}"] == 0:
                return name
    raise ValueError(f"no region key column; columns: {df.columns[:10]}")


def join_features(
    features: DataFrame, metrics: DataFrame, feature_key: str, metric_key: str
) -> DataFrame:
    """Features with metrics, inner, on differently named keys read as whole numbers."""
    left = features.withColumn("__key", to_whole(quoted(feature_key)))
    right = metrics.withColumn("__key", to_whole(quoted(metric_key)))
    return left.join(right, "__key", "inner").drop("__key")


def enrich_features(
    features: DataFrame,
    metrics: DataFrame,
    feature_key: str,
    metric_key: str,
    value: str = "accuracy",
    support: str = "n",
    min_support: int = MIN_SUPPORT,
    plot: str = "acc_plot",
) -> DataFrame:
    """Every feature with its value, support, masked value, fill and opacity.

    A key that is blank, bad or without metrics gives a null value and support 0.
    """
    left = features.withColumn("__key", to_whole(quoted(feature_key)))
    right = metrics.select(
        to_whole(quoted(metric_key)).alias("__key"), quoted(value), quoted(support)
    )
    shown = supported_value(quoted(value), quoted(support), min_support)
    return (
        left.join(right, "__key", "left")
        .drop("__key")
        .withColumn(support, F.coalesce(quoted(support), F.lit(0)))
        .withColumn(plot, shown)
        .withColumn("fill", two_colour_fill(quoted(plot)))
        .withColumn("opacity", F.when(quoted(plot).isNotNull(), 0.75).otherwise(0.3))
    )


def metric_layers(
    features: DataFrame,
    combined: DataFrame,
    feature_key: str,
    metrics: Sequence[str] = ("FP_rate", "FN_rate"),
    key: str = "community_area",
    model: str = "ModelType",
    min_support: int = MIN_SUPPORT,
) -> DataFrame:
    """All features once per model and metric, with value, range and fill.

    One long table (write it with ``partition_by=['ModelType', 'metric']``): the
    metrics are unpivoted and their ranges computed for all layers together.
    """
    present = [m for m in metrics if m in combined.columns]
    if not present:
        raise ValueError(f"none of the metrics {tuple(metrics)} found")
    has_n = "n_obs" in combined.columns
    n = quoted("n_obs").cast("double") if has_n else F.lit(None).cast("double")
    long = combined.select(
        quoted(key).alias("__key"),
        quoted(model).alias(model),
        n.alias("n_obs"),
        *[quoted(m).cast("double").alias(m) for m in present],
    ).unpivot(["__key", model, "n_obs"], present, "metric", "value")
    long = materialise(long, "layers")  # read for the ranges and for the join
    ranges = metric_range(
        long, "value", "n_obs" if has_n else None, min_support, groups=[model, "metric"]
    )
    named = features.withColumn("__key", to_whole(quoted(feature_key)))
    # Every layer shows every feature, so each feature row is repeated per layer. The list has one
    # entry per model and metric.
    names = ranges.agg(F.sort_array(F.collect_list(F.struct(model, "metric", "vmin", "vmax")))).scalar()
    shown = named.withColumn("__layers", names).withColumn("__layer", F.explode("__layers"))
    shown = shown.select("*", "__layer.*").drop("__layers", "__layer")
    joined = shown.join(long, ["__key", model, "metric"], "left").drop("__key")
    ramp = ramp_fill(F.col("value"), F.col("vmin"), F.col("vmax"), ERROR_RAMP)
    return _styled(joined, ramp, min_support)


def _styled(df: DataFrame, fill: Column, min_support: int) -> DataFrame:
    visible = supported_value(F.col("value"), F.col("n_obs"), min_support, null_n="show").isNotNull()
    return df.withColumns(
        {
            "fill": F.when(visible, fill).otherwise(NO_DATA_COLOUR),
            "opacity": F.when(visible, 0.8).otherwise(0.3),
        }
    )


def observed_layer(
    features: DataFrame,
    combined: DataFrame,
    feature_key: str,
    metric: str = "Arrest_Rate_true",
    key: str = "community_area",
    model: str = "ModelType",
    min_support: int = MIN_SUPPORT,
) -> DataFrame:
    """All features with the observed rate: one value per region, whatever the model."""
    rows = combined.select(
        quoted(key).alias("__key"),
        quoted(model).alias("__model"),
        quoted(metric).cast("double").alias("value"),
        quoted("n_obs").cast("double").alias("n_obs"),
    ).na.drop(subset=["__key", "value"])
    single = materialise(first_per_key(rows, "__key", ["__model"]).drop("__model"), "observed")
    extent = metric_range(single, "value", "n_obs", min_support)
    bounds = extent.agg(F.first(F.struct("vmin", "vmax"))).scalar()
    joined = (
        features.withColumn("__key", to_whole(quoted(feature_key)))
        .join(single, "__key", "left")
        .drop("__key")
        .withColumn("__extent", bounds)
        .select("*", "__extent.*")
        .drop("__extent")
    )
    ramp = ramp_fill(F.col("value"), F.col("vmin"), F.col("vmax"), RATE_RAMP)
    return _styled(joined, ramp, min_support)


def grouped_layers(
    features: DataFrame,
    tables: Mapping[str, DataFrame],
    feature_key: str,
    key: str,
    metrics: Sequence[str],
    model: str = "ModelType",
) -> DataFrame:
    """Features that have a value, once per model and metric, each layer on a scale and ramp of its own.

    ``tables`` holds per-group metric tables by model, keyed by ``key``. Keys of both sides are read as whole
    numbers; a feature or group whose key is blank, bad or unmatched is in no layer, nor is a missing value.
    A scale ends at the least and the greatest value shown; where they are equal, the ramp's first colour is
    taken. A metric that a model's table lacks has no layer for it. Features move once, and only
    with the values: the scales come from keys and values alone.
    """
    long = []
    for name, df in tables.items():
        present = [m for m in metrics if m in df.columns]
        if not present:
            raise ValueError(f"none of the metrics {tuple(metrics)} in the table of {name}")
        wide = df.select(to_whole(quoted(key)).alias("__key"), *[quoted(m).cast("double").alias(m) for m in present])
        long.append(tag_rows(wide.unpivot(["__key"], present, "metric", "value"), model, name))
    keyed = features.withColumn("__key", to_whole(quoted(feature_key)))
    held = stack_tables(long).na.drop(subset=["__key", "value"])
    held = materialise(held.join(keyed.select("__key"), "__key", "left_semi"), "layers")
    ranges = held.groupBy(model, "metric").agg(F.min("value").alias("vmin"), F.max("value").alias("vmax"))
    ramp = ramp_column(RATE_RAMP)
    for metric in metrics:
        if metric in LAYER_RAMPS:
            ramp = F.when(F.col("metric") == metric, ramp_column(LAYER_RAMPS[metric])).otherwise(ramp)
    # Values are coloured where they are read, before the join decides how many tasks there are.
    scaled = held.join(F.broadcast(ranges), [model, "metric"])
    filled = scaled.withColumn("__fill", ramp_fill_from(F.col("value"), F.col("vmin"), F.col("vmax"), ramp))
    return keyed.join(filled, "__key").withColumn("fill", F.col("__fill")).drop("__key", "__fill")


def feature_columns(features: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Feature properties as columns: output name to property name."""
    out = {name: property_column(features, prop) for name, prop in fields.items()}
    return features.withColumns(out)
