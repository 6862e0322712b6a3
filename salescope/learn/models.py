"""Training on Spark ML: feature assembly, model factories, fixed-split grids, persistence."""

from __future__ import annotations

import itertools
import math
import time
from collections.abc import Iterator, Sequence

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, NaiveBayes, OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import Bucketizer, Imputer, OneHotEncoder, SQLTransformer, StringIndexer, VarianceThresholdSelector, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from salescope.learn import gram
from salescope.learn.metrics import wide_metrics
from salescope.operators.neighbours import knn_regression
from salescope.operators.ordered import medians, one_row
from salescope.operators.series import random_split
from salescope.session import cut_lineage

SEED = 42

# Parameter grids, two values for each parameter that Spark ML has.
REGRESSION_GRID = {
    "DecisionTree": {"max_depth": [10, 20], "min_samples_leaf": [1, 4]},
    "LinearRegression": {"fit_intercept": [True, False], "positive": [True, False]},
    "RandomForest": {"n_estimators": [100, 200], "max_depth": [10, 20]},
    "BoostedTrees": {"n_estimators": [100, 200], "max_depth": [3, 7], "learning_rate": [0.1, 0.2]},
    "KNN": {"n_neighbors": [3, 7], "weights": ["uniform", "distance"], "p": [1, 2]},
    "Ridge": {"alpha": [0.1, 1.0], "fit_intercept": [True, False]},
    "Lasso": {"alpha": [0.1, 1.0], "fit_intercept": [True, False], "max_iter": [1000, 5000]},
    "ElasticNet": {"alpha": [0.1, 1.0], "l1_ratio": [0.3, 0.7], "max_iter": [1000, 5000]},
}


def indexed_one_hot(columns: Sequence[str]) -> list:
    """Sparse one-hot stages with alphabetical codes, for categories of any width."""
    codes = [f"{c}_code" for c in columns]
    return [
        StringIndexer(inputCols=list(columns), outputCols=codes, stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=codes, outputCols=[f"{c}_vec" for c in columns], dropLast=False),
    ]


def assemble(numeric: Sequence[str], categorical: Sequence[str] = ()) -> Pipeline:
    """Pipeline from raw columns to ``features``.

    Columns that are constant in the data fitted on are left out: they carry nothing, and with them the
    normal equations have no unique solution.
    """
    stages = indexed_one_hot(categorical) if categorical else []
    inputs = [*numeric, *[f"{c}_vec" for c in categorical]]
    return Pipeline(
        stages=[
            *stages,
            VectorAssembler(inputCols=inputs, outputCol="all_features"),
            VarianceThresholdSelector(featuresCol="all_features", outputCol="features", varianceThreshold=0.0),
            SQLTransformer(statement="SELECT * EXCEPT (all_features) FROM __THIS__"),
        ]
    )


def impute(df: DataFrame, numeric: Sequence[str], one_hot: Sequence[str] = ()) -> DataFrame:
    """Median for numeric columns, 0 for one-hot columns."""
    filled = Imputer(strategy="median", inputCols=list(numeric), outputCols=list(numeric), relativeError=0.0001).fit(df)
    return filled.transform(df).fillna(0, subset=list(one_hot))


def impute_exact(df: DataFrame, numeric: Sequence[str], one_hot: Sequence[str] = ()) -> DataFrame:
    """Like ``impute`` with the interpolated median; all columns' medians come from the same passes."""
    middle = one_row(medians(df, numeric))
    out = df.withColumns({c: F.coalesce(F.col(c), middle[c]) for c in numeric})
    return out.fillna(0, subset=list(one_hot)) if one_hot else out


def regressor(name: str, rows: int = 1, label_std: float = 1.0, **p):
    """Spark ML estimator for a model name and its parameters.

    Penalties follow the usual definitions on the unscaled label: ridge adds alpha |w|^2 to the summed
    loss, lasso and elastic net add alpha (l1 |w| + (1 - l1) |w|^2 / 2) to half the mean loss. Spark
    averages the loss and applies the squared penalty to a label of unit deviation, hence ``rows`` and
    ``label_std``. Spark picks the solver by the real width of the features: normal equations (one pass) as far as
    it can hold them, l-bfgs beyond.
    """
    common = {"featuresCol": "features", "labelCol": "label"}
    linear = {**common, "standardization": False, "fitIntercept": p.get("fit_intercept", True), "solver": "auto",
              "maxIter": p.get("max_iter", 1000), "tol": 1e-10}
    if name == "LinearRegression":
        # without a penalty scaling changes no coefficient, and it settles collinear columns
        return LinearRegression(**{**linear, "standardization": True, "tol": 1e-6})
    if name == "Ridge":
        return LinearRegression(**linear, regParam=p["alpha"] / rows * label_std, elasticNetParam=0.0)
    if name in ("Lasso", "ElasticNet"):
        l1 = p.get("l1_ratio", 1.0)
        size = l1 + label_std * (1 - l1)
        return LinearRegression(**linear, regParam=p["alpha"] * size, elasticNetParam=l1 / size)
    if name == "DecisionTree":
        return DecisionTreeRegressor(**common, maxDepth=p["max_depth"], minInstancesPerNode=p.get("min_samples_leaf", 1), seed=SEED)
    if name == "RandomForest":
        return RandomForestRegressor(**common, numTrees=p["n_estimators"], maxDepth=p["max_depth"], seed=SEED)
    if name == "BoostedTrees":
        return GBTRegressor(**common, maxIter=p["n_estimators"], maxDepth=p["max_depth"], stepSize=p["learning_rate"], seed=SEED)
    raise ValueError(f"unknown model {name}")


#: Bins that Spark's trees cut a feature into.
BINS = 32


def tree_borders(data: DataFrame, features: str, width: int) -> dict[int, list[float]]:
    """Quantiles of the rows as borders of bins, by feature; one of few values (a guess does) needs none."""
    spread = data.select(vector_to_array(features).alias("x"))
    counts = spread.agg(*[F.approx_count_distinct(F.col("x")[i]) for i in range(width)]).first()
    many = [i for i in range(width) if counts[i] > BINS]
    steps = [i / BINS for i in range(1, BINS)]
    found = spread.agg(*[F.percentile_approx(F.col("x")[i], steps, 1000) for i in many]).first() if many else []
    return {i: sorted(set(own)) for i, own in zip(many, found)}


def binned(data: DataFrame, features: str, width: int, borders: dict[int, list[float]]) -> DataFrame:
    """``data`` with the bins of the features that have borders in the place of their values: all that a tree learns from them."""
    if not borders:
        return data
    names, codes = [f"_x{i}" for i in borders], [f"_b{i}" for i in borders]
    spread = data.withColumn("_x", vector_to_array(features)).withColumns({f"_x{i}": F.col("_x")[i] for i in borders})
    splits = [[-math.inf, *own, math.inf] for own in borders.values()]
    coded = Bucketizer(inputCols=names, outputCols=codes, splitsArray=splits, handleInvalid="keep").transform(spread)
    whole = F.array(*[F.col(f"_b{i}") if i in borders else F.col("_x")[i] for i in range(width)])
    return coded.withColumn(features, array_to_vector(whole)).drop("_x", *names, *codes)


def cells_of(train: DataFrame, features: str) -> DataFrame:
    """Equal ``features`` as one row with the mean label and their number in ``rows``.

    Squared-loss trees and their boosting make the same of them as of the rows. A null label is none: it makes its cell's mean NaN.
    """
    label = F.coalesce(F.col("label").cast("double"), F.lit(math.nan))
    own = vector_to_array(features)
    cells = train.groupBy(own.alias("_x")).agg(F.avg(label).alias("label"), F.count(F.lit(1)).cast("double").alias("rows"))
    return cut_lineage(cells.select(array_to_vector("_x").alias(features), "label", "rows"))


def label_size(data: DataFrame) -> tuple[int, float]:
    """Rows and population deviation of the label of the train split."""
    n, std = data.where(F.col("split") == "train").agg(F.count("label"), F.stddev_pop("label")).first()
    return n, std or 1.0


def classifier(name: str, classes: int = 2, width: int = 1, trees: int = 100, depth: int | None = None):
    """Spark ML classifier for a model name; trees are 10 deep by default, boosted ones 5."""
    depth = depth if depth is not None else 5 if name == "BoostedTrees" else 10
    common = {"featuresCol": "features", "labelCol": "label"}
    if name == "LogisticRegression":
        return LogisticRegression(**common, maxIter=1000)
    if name == "NaiveBayes":
        return NaiveBayes(**common, modelType="gaussian")
    if name == "DecisionTree":
        return DecisionTreeClassifier(**common, maxDepth=depth, seed=SEED)
    if name == "RandomForest":
        return RandomForestClassifier(**common, numTrees=trees, maxDepth=depth, seed=SEED)
    if name == "BoostedTrees":
        boosted = GBTClassifier(**common, maxIter=trees, maxDepth=depth, seed=SEED)
        return boosted if classes == 2 else OneVsRest(classifier=boosted, **common)
    if name == "NeuralNetwork":
        return MultilayerPerceptronClassifier(**common, layers=[width, 50, classes], maxIter=200, seed=SEED)
    raise ValueError(f"unknown model {name}")


def combinations(options: dict[str, list]) -> Iterator[dict]:
    for values in itertools.product(*options.values()):
        yield dict(zip(options, values))


def run_name(model: str, params: dict) -> str:
    """Model name and sorted parameters, the parameter part cut at 100 characters."""
    text = "_".join(f"{k}={v}" for k, v in sorted(params.items()))
    return f"{model}_{text[:97] + '...' if len(text) > 100 else text}"


def score(model: Transformer, data: DataFrame) -> DataFrame:
    """Batch predictions for a feature table."""
    return model.transform(data)


RUN_SCHEMA = (
    "model_name string, config_num int, run_name string, training_time double, params map<string,string>, "
    + ", ".join(f"{s}_{m} double" for s in ("train", "val", "test") for m in ("rmse", "mae", "r2"))
)


def regression_grid(data: DataFrame, grid: dict[str, dict], key: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Train every configuration on the train split of ``data`` (features, label, split).

    Linear models of all kinds are solved together from ``columns``. Returns the run table and the predictions of all runs, one
    column per run, for ensembles.
    """
    fixed = data.persist()
    train = fixed.where(F.col("split") == "train")
    linear = {k: v for k, v in grid.items() if k in gram.KINDS}
    solved = {r["run_name"]: r for r in gram.linear_grid(fixed, gram.Design(list(columns)), linear)} if linear else {}
    rows, scored = [], fixed
    for name, options in grid.items():
        for number, params in enumerate(combinations(options), 1):
            start = time.perf_counter()
            column = f"p{len(rows)}"
            if name in gram.KINDS:
                row = dict(solved[run_name(name, params)])
                model = row.pop("model")
                terms = [F.col(c) * F.lit(float(w)) for c, w in zip(columns, model.weights)]
                scored = scored.withColumn(column, sum(terms, F.lit(model.intercept)))
                rows.append(row)
                continue
            if name == "KNN":
                predictions = cut_lineage(
                    knn_regression(train, fixed, columns, "label", key, params["n_neighbors"], params["weights"], params["p"])
                )
                scored = scored.join(predictions.withColumnRenamed("prediction", column), key)
            else:
                scored = regressor(name, **params).setPredictionCol(column).fit(train).transform(scored)
            seconds = time.perf_counter() - start
            metrics = wide_metrics(scored.select("split", "label", column), prediction=column).first().asDict()
            rows.append(
                {"model_name": name, "config_num": number, "run_name": run_name(name, params), "training_time": seconds,
                 "params": {k: str(v) for k, v in params.items()}, **metrics}
            )
    names = [f.split()[0] for f in RUN_SCHEMA.replace("map<string,string>", "map").split(", ")]
    runs = data.sparkSession.createDataFrame([tuple(r[c] for c in names) for r in rows], RUN_SCHEMA)
    return runs, scored


def save_and_reload(model: PipelineModel, path: str, sample: DataFrame, rows: int = 5) -> tuple[PipelineModel, DataFrame]:
    """Persist a fitted pipeline, load it again and score a few rows with the copy."""
    model.write().overwrite().save(path)
    copy = PipelineModel.load(path)
    return copy, copy.transform(sample.limit(rows))


def refit(estimator, data: DataFrame, splits: Sequence[str] = ("train", "val")):
    """Fit a chosen configuration again on several splits together."""
    return estimator.fit(data.where(F.col("split").isin(*splits)))


def revenue_features(lines: DataFrame, target: str = "total_price", seed: int = SEED) -> DataFrame:
    """Leak-free columns for line revenue or quantity: time, cycles, price and ingredient count, plus ``split``.

    Neither quantity nor total price is among them, except as the label.
    """
    from salescope.functions.items import ingredient_count
    from salescope.functions.times import add_cycles, clock_hour, flag

    dated = lines.withColumns(
        {
            "hour": clock_hour(F.col("order_time")), "day_of_week": F.weekday("order_date"), "month": F.month("order_date"),
            "is_weekend": flag(F.weekday("order_date") >= 5), "ingredient_count": ingredient_count(F.col("ingredients")),
        }
    )
    cycled = add_cycles(dated, {"hour": 24, "day_of_week": 7, "month": 12}, {"day_of_week": "day"})
    split = random_split(cycled, ["order_id", "line_no", "item_id"], seed)
    return split.select(
        "order_id", "line_no", "item_id", *REVENUE_NUMERIC, *REVENUE_CATEGORIES, F.col(target).alias("label"), "split"
    ).fillna(0, subset=REVENUE_NUMERIC)


REVENUE_NUMERIC = [
    "hour", "day_of_week", "month", "is_weekend", "hour_sin", "hour_cos", "day_sin", "day_cos", "month_sin", "month_cos",
    "unit_price", "ingredient_count",
]
REVENUE_CATEGORIES = ["category", "item_size", "item_name"]
