"""The exploratory rate reports of a prepared table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from outcomelens.operators import rates as R


def exploratory_reports(df: DataFrame, label: str = "Arrest") -> dict[str, DataFrame]:
    """Every report whose columns exist, each from its own columns.

    Reports by value range and by hour store their merged totals while they are built; the rest is lazy.
    A stored ``BlockFreq`` counts the whole table and is preferred to counting a sample anew.
    """
    have = set(df.columns)
    reports: dict[str, DataFrame] = {}
    if "Beat" in have:
        rate = R.outcome_rate(df, ["Beat"], label)
        reports["rate_by_beat"] = R.by_rate(rate, ["Beat"])
        reports["rate_by_beat_in_order"] = R.by_key(rate, "Beat")
    if "Block" in have:
        reports["busiest_blocks"] = R.busiest_groups(df, "Block", label)
    if "BlockFreq" in have:
        logged = df.withColumn("BlockFreqLog", R.log_count(df["BlockFreq"]))
        reports["rate_by_block_frequency"] = R.rate_by_bin(logged, "BlockFreqLog", label, 20).orderBy("bin")
    elif "Block" in have:
        reports["rate_by_block_frequency"] = R.rate_by_frequency_bin(df, "Block", label).orderBy("bin")
    if {"Hour", "DayOfWeek"} <= have:
        reports["hour_by_day"] = R.outcome_pivot(df, "DayOfWeek", "Hour", range(24), label).orderBy("DayOfWeek")
    if "Primary Type" in have:
        reports["rate_by_type"] = R.by_rate(R.outcome_rate(df, ["Primary Type"], label), ["Primary Type"])
    for key in ("Hour", "Year", "Month", "DayOfWeek"):
        if key in have:
            reports[f"rate_by_{key.lower()}"] = R.outcome_rate(df, [key], label).orderBy(key)
    if "Season" in have:
        reports["rate_by_season"] = R.rate_by_season(df, "Season", label)
    if "Hour" in have:
        reports["intensity_by_hour"] = R.intensity(df, "Hour", label).orderBy("Hour")
    if {"Hour", "IsWeekend"} <= have:
        reports["rate_by_hour_and_weekend"] = R.outcome_rate(df, ["Hour", "IsWeekend"], label).orderBy(
            "Hour", "IsWeekend"
        )
    return reports
