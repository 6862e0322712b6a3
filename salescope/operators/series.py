"""Lags, moving means, best rows and splits.

Hourly and daily series hold at most 24 rows a calendar day, so a window over
the whole series is bounded by the calendar. ``keys`` (a shop, a product) splits
the series and its windows. Raw lines never pass through an unpartitioned window.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from salescope.functions.times import add_cycles, flag
from salescope.operators.ordered import number_rows, running
from salescope.session import cut_lineage

# Order of the demand model's inputs.
DEMAND_FEATURES = [
    "hour", "day_of_week", "month", "day_of_month", "week_of_year", "is_weekend",
    "hour_sin", "hour_cos", "day_sin", "day_cos", "month_sin", "month_cos",
    "day_of_month_sin", "day_of_month_cos",
    "prev_hour_units", "same_hour_yesterday", "rolling_3h_avg", "rolling_24h_avg",
]


def add_demand_calendar(hourly: DataFrame) -> DataFrame:
    d = F.col("date")
    out = hourly.withColumns(
        {
            "day_of_week": F.weekday(d),
            "month": F.month(d),
            "day_of_month": F.dayofmonth(d),
            "week_of_year": F.weekofyear(d),
            "is_weekend": flag(F.weekday(d) >= 5),
        }
    )
    cycles = {"hour": 24, "day_of_week": 7, "month": 12, "day_of_month": 31}
    return add_cycles(out, cycles, {"day_of_week": "day"})


def add_lags(hourly: DataFrame, value: str = "units", keys: Sequence[str] = (), include_current: bool = True) -> DataFrame:
    """Previous row, same hour on the previous day on record, and 3- and 24-row means.

    The means include the row itself; ``include_current=False`` ends them one row earlier.
    """
    order = W.partitionBy(*keys).orderBy("date", "hour")
    last = 0 if include_current else -1
    return hourly.withColumns(
        {
            f"prev_hour_{value}": F.lag(value).over(order),
            "same_hour_yesterday": F.lag(value).over(W.partitionBy(*keys, "hour").orderBy("date")),
            "rolling_3h_avg": F.avg(value).over(order.rowsBetween(last - 2, last)),
            "rolling_24h_avg": F.avg(value).over(order.rowsBetween(last - 23, last)),
        }
    )


def demand_features(hourly: DataFrame, keys: Sequence[str] = (), include_current: bool = True) -> DataFrame:
    """Calendar, cycles and lags of the hourly series; rows without a full set are dropped."""
    return (
        hourly.transform(add_demand_calendar)
        .transform(add_lags, "units", keys, include_current)
        .dropna(subset=DEMAND_FEATURES)
    )


def centred_mean(order: str, value: str, half: int = 3) -> Column:
    """Mean of the row and ``half`` rows on each side, null unless all of them exist."""
    window = W.orderBy(order).rowsBetween(-half, half)
    return F.when(F.count(value).over(window) == 2 * half + 1, F.avg(value).over(window))


def best_rows(df: DataFrame, keys: Sequence[str], *order: Column, n: int = 1) -> DataFrame:
    """First ``n`` rows of each group in the given order."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_r", rank).where(F.col("_r") <= n).drop("_r")


def best_value(df: DataFrame, keys: Sequence[str], columns: Sequence[str], *order: Column) -> DataFrame:
    """Columns of the first row per group as an aggregate (partial per task, so hot groups stay cheap)."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_b")).select(*keys, "_b.*")


def tail_rows(series: DataFrame, order: str, n: int) -> DataFrame:
    return series.orderBy(F.col(order).desc()).limit(n)


def head_rows(series: DataFrame, order: str, n: int) -> DataFrame:
    return series.orderBy(F.col(order).asc()).limit(n)


def last_value_forecast(series: DataFrame, order: Sequence[str], value: str) -> Column:
    """The last value of a series as a scalar."""
    return series.agg(F.max_by(value, F.struct(*order)).alias("v")).scalar()


def moving_average_forecast(series: DataFrame, order: Sequence[str], value: str, window: int = 7) -> Column:
    """Mean of the last ``window`` rows as a scalar; null when the series is shorter."""
    last = series.orderBy(*[F.col(c).desc() for c in order]).limit(window)
    return last.agg(F.when(F.count(value) == window, F.avg(value)).alias("v")).scalar()


def spread(key: Column, seed: int = 0) -> Column:
    """Uniform 32-bit number from an integer key: plain arithmetic, equal on any engine."""
    start = F.pmod(key.cast("long") + F.lit(seed), F.lit(1 << 31))
    return F.pmod(start * F.lit(2654435761), F.lit(1 << 32))


def row_spread(columns: Sequence[str], seed: int = 42) -> Column:
    """Uniform 32-bit number from several integer columns."""
    first = spread(F.lit(seed))
    return reduce(lambda h, c: spread(h + F.col(c).cast("long")), columns, first)


def random_split(df: DataFrame, keys: Sequence[str], seed: int = 42, train: float = 0.8, val: float = 0.1) -> DataFrame:
    """Add ``split``; a row's side depends on its integer keys and the seed only, not on partitioning."""
    u = row_spread(keys, seed) / F.lit(float(1 << 32))
    return df.withColumn("split", F.when(u < train, "train").when(u < train + val, "val").otherwise("test"))


def chronological_split(series: DataFrame, order: Sequence[str], train: float = 0.7, val: float = 0.15) -> DataFrame:
    """Add ``split`` by row position in a calendar-bounded series: floor of each share, the rest is test."""
    whole = W.orderBy(*order)
    everything = whole.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    n = F.count(F.lit(1)).over(everything)
    cut1 = F.floor(n * F.lit(train))
    cut2 = cut1 + F.floor(n * F.lit(val))
    position = F.row_number().over(whole)
    return series.withColumn("split", F.when(position <= cut1, "train").when(position <= cut2, "val").otherwise("test"))


def ordered_split(df: DataFrame, order: Sequence[Column], test: float = 0.2) -> DataFrame:
    """Unshuffled cut of a table of any size: the last ``ceil(test * n)`` rows are the test side."""
    numbered = number_rows(df, order, "_position")
    n = numbered.agg(F.count(F.lit(1)).alias("n")).scalar()
    first_test = n - F.ceil(n * F.lit(test))
    return numbered.withColumn("split", F.when(F.col("_position") < first_test, "train").otherwise("test")).drop("_position")


#: Rows of a label that are numbered in one task, or so.
SLICE_ROWS = 1 << 16
#: Labels with their allotment are broadcast up to so many, beyond that joined.
FEW_LABELS = 1 << 14


def allotted(counts: DataFrame, label: str, test: float) -> DataFrame:
    """``counts`` (label, n) with ``_take``: ``ceil(test * all)`` rows dealt to the labels by largest remainder (ties: larger, then first label)."""
    share = F.col("n") * F.lit(test)
    parts = counts.withColumns({"_floor": F.floor(share), "_rest": F.round(share - F.floor(share), 9)})
    left = parts.agg((F.ceil(F.sum("n") * F.lit(test)) - F.sum("_floor")).alias("left")).scalar()
    ranked = running(parts.withColumn("_order", F.struct("_rest", "n")), "_order", descending=True, tie=[label], position="_place")
    return ranked.select(label, "n", (F.col("_floor") + (F.col("_place") <= left).cast("long")).alias("_take"))


def stratified_split(df: DataFrame, label: str, keys: Sequence[str], seed: int = 42, test: float = 0.2) -> DataFrame:
    """Exactly ``ceil(test * n)`` rows of the table are the test side, each label's part in proportion, lowest hash first.

    A label is cut into slices of about ``SLICE_ROWS`` rows by its own count, so one that holds most rows is numbered in parallel.
    """
    counts = cut_lineage(allotted(df.groupBy(label).agg(F.count(F.lit(1)).alias("n")), label, test))
    known = counts.select(F.col(label).alias("_label"), F.ceil(F.col("n") / SLICE_ROWS).alias("_slices"), "_take")
    known = F.broadcast(known) if counts.count() <= FEW_LABELS else known
    tagged = df.withColumn("_h", row_spread(keys, seed)).join(known, F.col(label).eqNullSafe(F.col("_label")))
    tagged = tagged.withColumn("_slice", F.floor(F.col("_h") * F.col("_slices") / F.lit(float(1 << 32))))
    sizes = tagged.groupBy(label, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(label).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(F.col(label).alias("_of"), F.col("_slice").alias("_s"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = tagged.withColumn("_r", F.row_number().over(W.partitionBy(label, "_slice").orderBy("_h", *keys)))
    joined = placed.join(starts, F.col(label).eqNullSafe(F.col("_of")) & (F.col("_slice") == F.col("_s")))
    is_test = F.col("_before") + F.col("_r") <= F.col("_take")
    return joined.select(*df.columns, F.when(is_test, "test").otherwise("train").alias("split"))


def shared_keys(df: DataFrame, keys: Sequence[str], split: str = "split") -> DataFrame:
    """Keys found in more than one split (empty when the splits are disjoint)."""
    seen = df.select(*keys, split).distinct()
    return seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("splits")).where(F.col("splits") > 1)


def forbidden_columns(df: DataFrame, forbidden: Sequence[str]) -> list[str]:
    """Names that must not be among the features, compared without case."""
    banned = {c.lower() for c in forbidden}
    return [c for c in df.columns if c.lower() in banned]
