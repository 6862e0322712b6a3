"""The whole feature chain and a summary of what it produced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from salescope.functions.items import add_ingredient_features, add_item_features
from salescope.functions.seasons import add_holidays, add_seasons
from salescope.functions.times import add_cycles, add_time_parts

# The columns looked for in each feature group.
FEATURE_GROUPS = {
    "time_features": ["year", "month", "day", "hour", "dayofweek", "week", "quarter"],
    "season_features": ["is_extreme_heat", "is_perfect_weather", "is_snowbird_season"],
    "business_features": ["price_per_unit", "is_bulk_order", "size_numeric"],
    "ingredient_features": ["ingredient_count", "is_vegetarian", "has_meat"],
    "cyclical_features": ["hour_sin", "hour_cos", "month_sin", "month_cos"],
}


def add_all_features(df: DataFrame, categories: Sequence[str] | None = None, priced: DataFrame | None = None) -> DataFrame:
    """All feature groups; ``priced`` has the unit prices of ``df`` without its joins, for the price edges."""
    return (
        df.transform(add_time_parts)
        .transform(add_holidays)
        .transform(add_seasons)
        .transform(add_item_features, categories, priced)
        .transform(add_ingredient_features)
        .transform(add_cycles)
    )


def feature_summary(df: DataFrame) -> DataFrame:
    """One row per feature group: how many of its columns exist and which."""
    rows = [
        (group, len(present), present)
        for group, names in FEATURE_GROUPS.items()
        for present in [[n for n in names if n in df.columns]]
    ]
    return df.sparkSession.createDataFrame(rows, "feature_group string, count int, features array<string>")


def by_prefix(columns: Sequence[str], prefixes: Sequence[str], first: Sequence[str] = ()) -> list[str]:
    """Columns in ``first`` that exist, then those starting with a prefix, each once."""
    picked = [c for c in first if c in columns]
    for prefix in prefixes:
        picked += [c for c in columns if c.startswith(prefix)]
    return list(dict.fromkeys(picked))
