"""The run table: ranking, ensembles, champions, overfit check and retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from salescope.operators.ordered import first_row
from salescope.operators.series import best_rows


def ranked_runs(runs: DataFrame, metric: str = "test_rmse", **where: str) -> DataFrame:
    """Runs of an experiment (column equals value), best metric first."""
    for column, value in where.items():
        runs = runs.where(F.col(column) == F.lit(value))
    return runs.orderBy(F.col(metric).asc_nulls_last(), "run_name")


def combined(*tables: DataFrame) -> DataFrame:
    """Run tables stacked by name; a column a table lacks is null."""
    out = tables[0]
    for other in tables[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def without_ensembles(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("model_name") != "Ensemble")


def top_runs(runs: DataFrame, n: int, metric: str = "val_rmse", ascending: bool = True, diverse: bool = False) -> DataFrame:
    """Best ``n`` runs; ``diverse`` keeps only the best run of each model type."""
    order = F.col(metric).asc() if ascending else F.col(metric).desc()
    pool = best_rows(runs, ["model_name"], order, F.col("run_name")) if diverse else runs
    return first_row(pool, order, F.col("run_name"), n=n)


def ensemble_weights(selected: DataFrame, weighting: str = "uniform", epsilon: float = 0.0, rmse: str = "val_rmse",
                     div_by_std: bool = False) -> DataFrame:
    """Add ``weight``: equal, or inverse validation error, summing to 1.

    ``div_by_std`` divides all weights by one number before they are normalised, which leaves them as they were.
    """
    everyone = W.partitionBy()
    raw = F.lit(1.0) if weighting == "uniform" else 1 / (F.col(rmse) + F.lit(epsilon))
    if div_by_std and weighting != "uniform":
        raw = raw / (F.stddev_samp("val_r2").over(everyone) + F.lit(1e-6))
    return selected.withColumn("_raw", raw).withColumn("weight", F.col("_raw") / F.sum("_raw").over(everyone)).drop("_raw")


def blended(scored: DataFrame, weights: dict[str, float], name: str = "prediction") -> DataFrame:
    """Weighted sum of prediction columns."""
    total: Column = F.lit(0.0)
    for column, weight in weights.items():
        total = total + F.col(column) * F.lit(weight)
    return scored.withColumn(name, total)


def blend_long(predictions: DataFrame, weights: DataFrame, keys: Sequence[str], run: str = "run_name") -> DataFrame:
    """Weighted sum of predictions held one row per key and run; ``weights`` has one row per chosen run."""
    joined = predictions.join(F.broadcast(weights.select(run, "weight")), run)
    return joined.groupBy(*keys).agg(F.sum(F.col("weight") * F.col("prediction")).alias("prediction"))


def champion(runs: DataFrame, metric: str = "val_rmse", ascending: bool = True) -> DataFrame:
    """The single best run; ties go to the lower configuration number."""
    order = F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()
    tie = [F.col(c) for c in ("config_num", "config", "run_name") if c in runs.columns]
    return first_row(runs, order, *tie)


def cluster_champion(runs: DataFrame, floor: float = 0.1) -> DataFrame:
    return champion(runs.where(F.col("silhouette") > floor), "silhouette", ascending=False)


def rule_champion(runs: DataFrame) -> DataFrame:
    """Most lift among runs that found rules, then most rules, then first by parameters."""
    keep = runs.where(F.col("association_rules") > 0)
    return first_row(keep, F.col("avg_lift").desc(), F.col("association_rules").desc(),
                     F.col("algorithm"), F.col("min_support"), F.col("metric"), F.col("min_threshold"))


def overfit_table(runs: DataFrame) -> DataFrame:
    """Gap between train and test R2 with its verdict."""
    gap = F.col("train_r2") - F.col("test_r2")
    verdict = (
        F.when((F.col("train_r2") < 0.5) & (F.col("test_r2") < 0.5), "underfit")
        .when(gap > 0.01, "overfit")
        .when(gap > 0, "acceptable")
        .otherwise("well fitted")
    )
    return runs.select("model_name", "run_name", "train_r2", "test_r2", gap.alias("gap"), verdict.alias("verdict"))


def name_of_run(model: Column, params: Column, limit: int = 100) -> Column:
    """Run name from a parameter map: sorted ``key=value`` parts, cut with dots beyond ``limit``."""
    parts = F.transform(F.array_sort(F.map_entries(params)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    text = F.array_join(parts, "_")
    short = F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit - 3), F.lit("..."))).otherwise(text)
    return F.concat(model, F.lit("_"), short)


# Bucket, words looked for in the lower-case run name, newest runs kept.
RETENTION = [("revenue", ["revenue", "total_price"], 88), ("quantity", ["quantity", "volume"], 112)]


def run_bucket(name: Column, buckets: Sequence[tuple[str, Sequence[str], int]] = RETENTION) -> Column:
    low = F.lower(F.coalesce(name, F.lit("")))
    out = F.when(low == "", "unnamed")
    for bucket, words, _ in buckets:
        hit = F.lit(False)
        for word in words:
            hit = hit | low.contains(word)
        out = out.when(hit, bucket)
    return out.otherwise("other")


def runs_to_delete(runs: DataFrame, name: str = "run_name", started: str = "started", key: str = "run_id",
                   buckets: Sequence[tuple[str, Sequence[str], int]] = RETENTION) -> DataFrame:
    """Unnamed runs and, per bucket, all but the newest runs; ``key`` identifies a run.

    Only the runs to keep are ranked (a short top list per bucket); the rest are found by an anti join.
    """
    tagged = runs.withColumn("bucket", run_bucket(F.col(name), buckets))
    limited = tagged.where(F.col("bucket").isin([b for b, _, _ in buckets]))
    kept = None
    for bucket, _, n in buckets:
        newest = first_row(limited.where(F.col("bucket") == bucket), F.col(started).desc(), F.col(name), F.col(key), n=n)
        kept = newest.select(key) if kept is None else kept.unionByName(newest.select(key))
    # kept holds at most the sum of the limits
    old = limited.join(F.broadcast(kept), key, "left_anti") if kept is not None else limited
    return old.unionByName(tagged.where(F.col("bucket") == "unnamed"))


def typed_parameters(params: Column) -> Column:
    """Parameters of a stored run as typed fields; text, numbers and layer tuples are recognised."""
    as_int = lambda k: F.try_element_at(params, F.lit(k)).try_cast("double").cast("int")
    as_double = lambda k: F.try_element_at(params, F.lit(k)).try_cast("double")
    layers = F.transform(
        F.filter(F.split(F.regexp_replace(F.try_element_at(params, F.lit("hidden_layer_sizes")), r"[()'\" ]", ""), ","), lambda x: x != ""),
        lambda x: x.cast("double").cast("int"),
    )
    return F.struct(
        *[as_int(k).alias(k) for k in ("max_depth", "min_samples_split", "min_samples_leaf", "n_estimators", "n_neighbors", "max_iter")],
        *[as_double(k).alias(k) for k in ("alpha", "l1_ratio", "learning_rate")],
        layers.alias("hidden_layer_sizes"),
    )


def comparison(results: DataFrame, by: str, ascending: bool = True, digits: int = 2) -> DataFrame:
    """Model comparison rounded for reading and ranked by one metric; models without one come last."""
    numeric = [c for c, t in results.dtypes if t == "double"]
    rounded = results.withColumns({c: F.round(c, digits) for c in numeric})
    order = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return rounded.orderBy(order, "model_name")


def derived_revenue(predicted_units: Column, unit_price: Column) -> Column:
    return predicted_units * unit_price
