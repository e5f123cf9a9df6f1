"""From raw incidents to the modelling tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelens.constants import (
    LINEAR_CATEGORICAL,
    LINEAR_COLUMNS,
    LINEAR_NUMERIC,
    PREPARED_COLUMNS,
    RAW_COLUMNS,
)
from outcomelens.functions.calendar import MONDAY0, SUNDAY1
from outcomelens.functions.parsing import parse_flag, to_whole
from outcomelens.operators.cleaning import (
    drop_missing,
    fill_missing_levels,
    keep_dated,
    keep_labelled,
)
from outcomelens.operators.columns import (
    keep_present,
    normalize_name,
    normalize_names,
    quoted,
    select_wanted,
)
from outcomelens.operators.features import add_calendar, key_counts
from outcomelens.operators.joins import attach_counts
from outcomelens.operators.sampling import stratified_sample_size
from outcomelens.session import materialise


def prepare_table(
    raw: DataFrame, sample_size: int | None = None, ids: Sequence[str] = ("id",)
) -> DataFrame:
    """Clean rows with calendar and frequency features, optionally a stratified sample.

    Frequencies count the whole cleaned table, before sampling. The cleaned rows are stored
    once; counting, the sample's cut and the result read them from there.
    """
    df = select_wanted(normalize_names(raw), [normalize_name(c) for c in RAW_COLUMNS], rename=True)
    df = keep_labelled(drop_missing(df, ["arrest"]), "arrest", "Arrest__label")
    df = keep_dated(df, "date", "DateTime")
    # Under the session's usual name matching "Arrest" and "arrest" are one column.
    df = df.drop("arrest").withColumnRenamed("Arrest__label", "Arrest")
    if "domestic" in df.columns:
        df = df.withColumn("domestic", parse_flag(quoted("domestic")))
    df = materialise(add_calendar(df, "DateTime", MONDAY0), "cleaned")
    counts = key_counts(df, "block", "BlockFreq") if "block" in df.columns else None
    if sample_size is not None:
        df = stratified_sample_size(df, "Arrest", ids, sample_size)
    if counts is not None:
        spread_by = [c for c in ids if c in df.columns]
        df = attach_counts(df, counts, "block", "BlockFreq", spread_by)
    spelled = {normalize_name(c): c for c in PREPARED_COLUMNS}
    df = df.select(*[quoted(c).alias(spelled.get(normalize_name(c), c)) for c in df.columns])
    return keep_present(df, [*PREPARED_COLUMNS, *[c for c in ids if c not in PREPARED_COLUMNS]])


def prepare_linear(raw: DataFrame, ids: Sequence[str] = ()) -> DataFrame:
    """Label, numeric and categorical columns of the linear model.

    The day of week counts from Sunday = 1 here. ``ids`` are kept for splitting.
    """
    named = normalize_names(raw)
    df = select_wanted(named, [*LINEAR_COLUMNS, *ids], on_none="error", rename=True)
    df = drop_missing(df, ["date", "arrest"])
    df = keep_dated(keep_labelled(df, "arrest", "label"), "date", "ts")
    if "domestic" in df.columns:
        df = df.withColumn("DomesticNum", parse_flag(quoted("domestic")))
    else:
        df = df.withColumn("DomesticNum", F.lit(None).cast("int"))
    if "community_area" in df.columns:
        df = df.withColumn("community_area", to_whole(quoted("community_area")))
    df = add_calendar(df, "ts", SUNDAY1)
    df = df.withColumns(
        {"label": F.col("label").cast("double"), **{c: F.col(c).cast("double") for c in LINEAR_NUMERIC}}
    )
    categorical = [c for c in LINEAR_CATEGORICAL if c in df.columns]
    df = fill_missing_levels(df, categorical)
    return keep_present(df, [*ids, "label", *categorical, *LINEAR_NUMERIC])
