"""Side-by-side comparisons of forecasters, classifiers and clusterings on one table each."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, functions as F

from salescope.learn import metrics, models
from salescope.learn.runs import comparison
from salescope.operators import clusters
from salescope.operators.neighbours import knn_classification, knn_regression
from salescope.operators.series import last_value_forecast, moving_average_forecast
from salescope.session import cut_lineage, fixed_and_spread, unsent

log = logging.getLogger(__name__)

#: Rows that a task of a classifier's passes is worth; tables of few bytes land in few partitions, whatever their rows.
TASK_ROWS = 20_000

# Models compared and their parameters.
FORECASTERS = {
    "Linear Regression": ("LinearRegression", {}),
    "Ridge Regression": ("Ridge", {"alpha": 1.0}),
    "Lasso Regression": ("Lasso", {"alpha": 0.1}),
    "ElasticNet": ("ElasticNet", {"alpha": 0.1, "l1_ratio": 0.5}),
    "KNN Regression": ("KNN", {"n_neighbors": 5}),
    "Decision Tree": ("DecisionTree", {"max_depth": 10}),
    "Random Forest": ("RandomForest", {"n_estimators": 100, "max_depth": 10}),
    "Boosted Trees": ("BoostedTrees", {"n_estimators": 100, "max_depth": 5, "learning_rate": 0.1}),
}
CLASSIFIERS = {
    "Logistic Regression": "LogisticRegression",
    "Naive Bayes": "NaiveBayes",
    "Decision Tree": "DecisionTree",
    "Random Forest": "RandomForest",
    "Boosted Trees": "BoostedTrees",
    "KNN": "KNN",
}


def _collect(results: dict[str, Callable[[], DataFrame]], schema: str, spark) -> DataFrame:
    """Run each entry to its one-row result. One whose settings are refused has a row of nulls; any other failure ends the run."""
    rows = []
    for name, run in results.items():
        try:
            rows.append((name, *run().first()))
        except (ValueError, IllegalArgumentException) as error:
            log.warning("%s was refused: %s", name, str(error)[:200])
            rows.append((name, *[None] * len(schema.split(","))))
    return spark.createDataFrame(rows, f"model_name string, {schema}")


def compare_forecasters(data: DataFrame, features: Sequence[str], key: str, order: Sequence[str], window: int | None = None,
                        forecasters: dict | None = None, guard: float = 0.0) -> DataFrame:
    """MAE, RMSE, MAPE and R2 on the test split, best RMSE first.

    ``data`` has label and split (train, test); features are scaled by the train rows. The last value and,
    with ``window``, a moving average serve as baselines.
    """
    train_rows = data.where(F.col("split") == "train")
    fixed = cut_lineage(clusters.standardise(data, features, train_rows))
    train, test = (fixed.where(F.col("split") == s) for s in ("train", "test"))
    assembler = models.assemble(features).fit(train)
    n, std = models.label_size(fixed)

    def measured(scored: DataFrame) -> DataFrame:
        parts = metrics.regression_columns()
        return scored.agg(parts["mae"].alias("mae"), parts["rmse"].alias("rmse"), metrics.mape(guard=guard).alias("mape"), parts["r2"].alias("r2"))

    def constant(value: Column) -> DataFrame:
        return measured(test.withColumn("prediction", value))

    def trained(kind: str, params: dict) -> DataFrame:
        if kind == "KNN":
            near = knn_regression(train, test, features, "label", key, params["n_neighbors"])
            return measured(test.join(near, key))
        model = models.regressor(kind, n, std, **params).fit(assembler.transform(train))
        return measured(model.transform(assembler.transform(test)))

    entries: dict[str, Callable[[], DataFrame]] = {"Naive Baseline": lambda: constant(last_value_forecast(train, order, "label"))}
    if window:
        entries["Moving Average"] = lambda: constant(moving_average_forecast(train, order, "label", window))
    for name, (kind, params) in (forecasters or FORECASTERS).items():
        entries[name] = lambda kind=kind, params=params: trained(kind, params)
    got = _collect(entries, "mae double, rmse double, mape double, r2 double", data.sparkSession)
    return comparison(got, "rmse")


def compare_classifiers(data: DataFrame, features: Sequence[str], key: str, classes: int = 2, trees: int = 100,
                        depth: int | None = None, chosen: dict[str, str] | None = None) -> DataFrame:
    """Accuracy and weighted precision, recall and F1 on the test split, best F1 first.

    Without ``depth`` each kind of tree has its own: 10, boosted ones 5.
    """
    fixed = fixed_and_spread(clusters.standardise(data, features, data.where(F.col("split") == "train")), TASK_ROWS)
    train, test = (fixed.where(F.col("split") == s) for s in ("train", "test"))
    assembler = models.assemble(features).fit(train)

    def trained(kind: str) -> DataFrame:
        if kind == "KNN":
            return metrics.classification_metrics(test.join(knn_classification(train, test, features, "label", key, 5), key))
        model = models.classifier(kind, classes, len(features), trees, depth).fit(assembler.transform(train))
        return metrics.classification_metrics(model.transform(assembler.transform(test)))

    entries = {name: (lambda kind=kind: trained(kind)) for name, kind in (chosen or CLASSIFIERS).items()}
    got = _collect(entries, "accuracy double, precision double, recall double, f1 double", data.sparkSession)
    return comparison(got, "f1", ascending=False, digits=4)


def compare_clusterings(df: DataFrame, key: str, features: Sequence[str], k: int = 5, eps: float = 0.5, min_samples: int = 5) -> DataFrame:
    """Silhouette (of squared distances), Davies-Bouldin and cluster count per method on scaled features, best silhouette first.

    Fewer than two clusters score -1 and 999.
    """
    scaled = cut_lineage(clusters.standardise(df.select(key, *features), features))
    n = scaled.count()
    methods = {
        "K-Means": ("KMeans", {"n_clusters": k, "n_init": 10}),
        "Hierarchical": ("Hierarchical", {"n_clusters": k}),
        "DBSCAN": ("DBSCAN", {"eps": eps, "min_samples": min_samples, "metric": "euclidean"}),
        "Gaussian Mixture": ("GMM", {"n_components": k}),
    }

    def measured(algorithm: str, params: dict) -> DataFrame:
        labels = clusters.fit_labels(scaled, key, features, [(algorithm, params)])[0]
        labelled = cut_lineage(scaled.join(unsent(labels, n), key))
        width = clusters.silhouette_squared(labelled, features).scalar()
        ratio = clusters.davies_bouldin(labelled, features, missing=999.0).scalar()
        return clusters.cluster_counts(labelled).select(width.alias("s"), ratio.alias("d"), F.col("clusters").cast("int"))

    entries = {name: (lambda a=a, p=p: measured(a, p)) for name, (a, p) in methods.items()}
    got = _collect(entries, "silhouette double, davies_bouldin double, clusters int", df.sparkSession)
    return comparison(got, "silhouette", ascending=False, digits=4)
