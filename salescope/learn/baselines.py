"""Baseline forecasts of the hourly series: means by key, last value and moving averages.

They serve as reference models next to trained ones and give a full run table
from one pass over the series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from salescope.learn.metrics import regression_columns
from salescope.learn.runs import name_of_run

MEANS = {"all": [], "hour": ["hour"], "weekday": ["weekday"], "hour_weekday": ["hour", "weekday"]}
WINDOWS = (3, 7, 24)


def _runs() -> list[tuple[str, int, str, str, str]]:
    """(prediction column, config number, model, parameter, value) of every baseline."""
    runs = [(f"mean_{k}", i, "MeanByKey", "key", k) for i, k in enumerate(MEANS, 1)]
    runs += [(f"moving_{w}", i, "MovingAverage", "window", str(w)) for i, w in enumerate(WINDOWS, 1)]
    return [*runs, ("last_value", 1, "LastValue", "shift", "1")]


def predictions(series: DataFrame, value: str = "units") -> DataFrame:
    """Long table: one row per hour and baseline with split, label, model, parameters and prediction.

    ``series`` has date, hour, split and the value; means use the train split only.
    """
    train = F.when(F.col("split") == "train", F.col(value))
    order = W.orderBy("date", "hour")
    keyed = series.withColumn("weekday", F.weekday("date")).withColumn("_all", F.avg(train).over(W.partitionBy()))
    wide = keyed
    for name, keys in MEANS.items():
        mean = F.avg(train).over(W.partitionBy(*keys)) if keys else F.col("_all")
        wide = wide.withColumn(f"mean_{name}", F.coalesce(mean, F.col("_all")))
    for w in WINDOWS:
        wide = wide.withColumn(f"moving_{w}", F.coalesce(F.avg(value).over(order.rowsBetween(-w, -1)), F.col("_all")))
    wide = wide.withColumn("last_value", F.coalesce(F.lag(value).over(order), F.col("_all")))
    each = F.array(
        *[
            F.struct(
                F.lit(model).alias("model_name"), F.lit(number).alias("config_num"),
                F.create_map(F.lit(param), F.lit(v)).alias("params"), F.col(column).cast("double").alias("prediction"),
            )
            for column, number, model, param, v in _runs()
        ]
    )
    long = wide.select("date", "hour", "split", F.col(value).cast("double").alias("label"), F.inline(each))
    return long.withColumn("run_name", name_of_run(F.col("model_name"), F.col("params")))


def run_table(long: DataFrame, by: Sequence[str] = ("model_name", "config_num", "run_name")) -> DataFrame:
    """RMSE, MAE and R2 per run and split, side by side."""
    per_split = long.groupBy(*by, "split").agg(*[c.alias(n) for n, c in regression_columns().items()])

    def of(split: str, metric: str) -> Column:
        return F.max(F.when(F.col("split") == split, F.col(metric))).alias(f"{split}_{metric}")

    return per_split.groupBy(*by).agg(*[of(s, m) for s in ("train", "val", "test") for m in ("rmse", "mae", "r2")])
