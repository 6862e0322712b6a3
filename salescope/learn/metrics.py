"""Regression and classification metrics as single aggregations over prediction columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def regression_columns(target: str = "label", prediction: str = "prediction") -> dict[str, Column]:
    """RMSE, MAE and R2 as aggregates; R2 from sums of squares around the mean."""
    y, p = F.col(target), F.col(prediction)
    error = y - p
    total = F.var_pop(y) * F.count(y)
    return {
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(F.abs(error)),
        "r2": 1 - F.try_divide(F.sum(error * error), total),
    }


def mape(target: str = "label", prediction: str = "prediction", guard: float = 0.0) -> Column:
    """Mean absolute percentage error; ``guard`` is added to the target before dividing.

    Null if a target is zero after that: no row leaves the mean unnoticed.
    """
    y, p = F.col(target), F.col(prediction)
    error = F.avg(F.abs(F.try_divide(y - p, y + F.lit(guard)))) * 100
    return F.when(F.count_if(y + F.lit(guard) == 0) == 0, error)


def regression_metrics(scored: DataFrame, by: Sequence[str] = ("split",), target: str = "label",
                       prediction: str = "prediction") -> DataFrame:
    return scored.groupBy(*by).agg(*[c.alias(n) for n, c in regression_columns(target, prediction).items()])


def wide_metrics(scored: DataFrame, target: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row with ``train_``, ``val_`` and ``test_`` RMSE, MAE and R2, from one pass."""
    long = regression_metrics(scored, ("split",), target, prediction)
    out = [
        F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}")
        for s in ("train", "val", "test")
        for m in ("rmse", "mae", "r2")
    ]
    return long.agg(*out)


def confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Count of rows for each (label, prediction) pair that occurs."""
    return scored.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("rows"))


def confusion_matrix(scored: DataFrame, classes: Sequence, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Confusion counts with one column per predicted class."""
    return scored.groupBy(label).pivot(prediction, list(classes)).count().fillna(0)


def classification_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1; an empty class counts 0."""
    cells = confusion(scored, label, prediction)
    per_class = (
        cells.select(F.col(label).alias("c"), F.col("rows").alias("support"), F.lit(0).alias("predicted"),
                     F.when(F.col(label) == F.col(prediction), F.col("rows")).otherwise(0).alias("hit"))
        .unionByName(cells.select(F.col(prediction).alias("c"), F.lit(0).alias("support"), F.col("rows").alias("predicted"),
                                  F.lit(0).alias("hit")))
        .groupBy("c")
        .agg(*[F.sum(x).cast("double").alias(x) for x in ("support", "predicted", "hit")])
    )
    precision = F.coalesce(F.try_divide("hit", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hit", "support"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    rows = F.sum("support")
    return per_class.agg(
        (F.sum("hit") / rows).alias("accuracy"),
        (F.sum(F.col("support") * precision) / rows).alias("precision"),
        (F.sum(F.col("support") * recall) / rows).alias("recall"),
        (F.sum(F.col("support") * f1) / rows).alias("f1"),
    )


def roc_auc(scored: DataFrame, positive: Column, score: str) -> DataFrame:
    """Area under the ROC curve from rank sums, ties at mid rank.

    Scores are counted first; the window runs over distinct scores.
    """
    from salescope.operators.ordered import running

    counted = scored.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    ranked = running(counted, "s", ["neg"])
    wins = F.sum(F.col("pos") * (F.col("running_neg") - F.col("neg") / 2))
    return ranked.agg(F.try_divide(wins, F.sum("pos") * F.sum("neg")).alias("roc_auc"))


def class_auc(scored: DataFrame, label: str, scores: Mapping[str, str]) -> DataFrame:
    """``class``, ``roc_auc`` and ``rows`` of each class against the rest, by its own score column, and a row ``mean`` over the classes.

    There is one job for each class; classes without a row, or with all of them, have no area and are left out of the mean.
    """
    parts = [
        roc_auc(scored.where(F.col(column).isNotNull()), F.col(label) == name, column).select(
            F.lit(name).alias("class"), "roc_auc", scored.where(F.col(label) == name).agg(F.count(F.lit(1))).scalar().alias("rows"))
        for name, column in scores.items()
    ]
    whole = reduce(DataFrame.unionByName, parts)
    return whole.unionByName(whole.agg(F.lit("mean").alias("class"), F.avg("roc_auc").alias("roc_auc"), F.sum("rows").alias("rows")))
