import numpy as np
import pytest
from pyspark.sql import functions as F

from salescope.learn import metrics, models, runs
from salescope.sources import files


@pytest.fixture(scope="module")
def line(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 2))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 5 + rng.normal(size=300) * 0.1
    rows = [(i, float(a), float(b), float(t), "train" if i < 200 else "val" if i < 250 else "test") for i, ((a, b), t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "key long, a double, b double, label double, split string")
    return models.assemble(["a", "b"]).fit(df).transform(df).persist()


def arrays(line):
    train = line.where("split = 'train'").toPandas()
    return train[["a", "b"]].to_numpy(), train["label"].to_numpy()


def test_ridge_solves_its_normal_equations(line):
    x, y = arrays(line)
    n, std = models.label_size(line)
    model = models.regressor("Ridge", n, std, alpha=50.0).fit(line.where("split = 'train'"))
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 50 * np.eye(2), xc.T @ yc)
    assert np.array(model.coefficients) == pytest.approx(want, rel=1e-6)


@pytest.mark.parametrize("name, alpha, l1", [("Lasso", 0.5, 1.0), ("ElasticNet", 0.5, 0.3)])
def test_sparse_penalties_satisfy_their_optimality(line, name, alpha, l1):
    x, y = arrays(line)
    n, std = models.label_size(line)
    params = {"alpha": alpha} | ({"l1_ratio": l1} if name == "ElasticNet" else {})
    w = np.array(models.regressor(name, n, std, **params).fit(line.where("split = 'train'")).coefficients)
    xc, yc = x - x.mean(0), y - y.mean()
    slope = xc.T @ (xc @ w - yc) / n + alpha * (1 - l1) * w
    assert slope == pytest.approx(-alpha * l1 * np.sign(w), abs=1e-4)


def test_grid_ensemble_and_champion(line):
    grid = {"LinearRegression": {"fit_intercept": [True, False]}, "DecisionTree": {"max_depth": [3], "min_samples_leaf": [1]},
            "KNN": {"n_neighbors": [3], "weights": ["uniform"], "p": [2]}}
    table, scored = models.regression_grid(line, grid, "key", ["a", "b"])
    rows = table.collect()
    assert [r["config_num"] for r in rows] == [1, 2, 1, 1]
    best = runs.champion(table).first()
    assert best["run_name"] == "LinearRegression_fit_intercept=True" and best["test_r2"] > 0.99
    chosen = runs.ensemble_weights(runs.top_runs(table, 3, diverse=True), "inverse_rmse", 1e-10).collect()
    assert len({r["model_name"] for r in chosen}) == 3 and sum(r["weight"] for r in chosen) == pytest.approx(1)
    columns = {r["run_name"]: f"p{i}" for i, r in enumerate(rows)}
    mixed = runs.blended(scored, {columns[r["run_name"]]: r["weight"] for r in chosen})
    assert metrics.wide_metrics(mixed).first()["test_r2"] > 0.9
    assert runs.without_ensembles(runs.combined(table, table.limit(1).withColumn("model_name", F.lit("Ensemble")))).count() == 4


def test_dividing_all_weights_changes_nothing(spark):
    df = spark.createDataFrame([("a", 1.0, 0.9), ("b", 2.0, 0.8)], "run_name string, val_rmse double, val_r2 double")
    one = [r["weight"] for r in runs.ensemble_weights(df, "inverse_rmse").orderBy("run_name").collect()]
    two = [r["weight"] for r in runs.ensemble_weights(df, "inverse_rmse", div_by_std=True).orderBy("run_name").collect()]
    assert one == pytest.approx([2 / 3, 1 / 3]) and two == pytest.approx(one)
    assert [r["weight"] for r in runs.ensemble_weights(df).collect()] == [0.5, 0.5]


def test_regression_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0, "test"), (3.0, 3.0, "test"), (5.0, 4.0, "test")], "label double, prediction double, split string")
    got = metrics.regression_metrics(df).first()
    assert (got["rmse"], got["mae"], got["r2"]) == (pytest.approx((2 / 3) ** 0.5), pytest.approx(2 / 3), pytest.approx(0.75))
    assert df.agg(metrics.mape().alias("m")).first()["m"] == pytest.approx((1 + 0 + 0.2) / 3 * 100)


def test_classification_metrics_with_an_empty_class(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "label string, prediction string")
    got = metrics.classification_metrics(df).first()
    assert got["accuracy"] == 0.5 and got["recall"] == 0.5
    assert got["precision"] == pytest.approx(0.5 * 0.5 + 0.25 * 0.5)
    assert got["f1"] == pytest.approx((2 * 0.5 + 1 * 2 / 3) / 4)
    wide = {r["label"]: (r["a"], r["b"], r["c"]) for r in metrics.confusion_matrix(df, ["a", "b", "c"]).collect()}
    assert wide == {"a": (1, 1, 0), "b": (0, 1, 0), "c": (1, 0, 0)}


def test_roc_auc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1)], "label int, s double")
    assert metrics.roc_auc(df, F.col("label") == 1, "s").first()[0] == pytest.approx((0.5 + 1 + 0 + 1) / 4)


def test_run_names_and_typed_parameters(spark):
    params = {"b": "2", "a": "x" * 120}
    df = spark.createDataFrame([("M", params), ("N", {"max_depth": "10.0", "hidden_layer_sizes": "(50, 20)", "alpha": "0.1", "n_neighbors": "oops"})],
                               "m string, p map<string,string>")
    got = [r[0] for r in df.select(runs.name_of_run(F.col("m"), F.col("p"))).collect()]
    assert got[0] == models.run_name("M", params) and len(got[0]) == 102 and got[0].endswith("...")
    typed = df.select(runs.typed_parameters(F.col("p")).alias("t")).collect()[1]["t"]
    assert (typed["max_depth"], typed["hidden_layer_sizes"], typed["alpha"], typed["n_neighbors"]) == (10, [50, 20], 0.1, None)


def test_retention_keeps_the_newest(spark):
    rows = [("Revenue_1", 1), ("total_price_2", 2), ("x_volume", 3), ("", 4), ("other", 5), (None, 6)]
    df = spark.createDataFrame(rows, "run_name string, started int")
    old = runs.runs_to_delete(df, key="started", buckets=[("revenue", ["revenue", "total_price"], 1), ("quantity", ["quantity", "volume"], 1)])
    assert sorted(r["started"] for r in old.collect()) == [1, 4, 6]


def test_overfit_verdicts(spark):
    df = spark.createDataFrame([("a", "a", 1.0, 0.9), ("b", "b", 0.95, 0.945), ("c", "c", 0.8, 0.9), ("d", "d", 0.02, 0.01)],
                               "model_name string, run_name string, train_r2 double, test_r2 double")
    assert [r["verdict"] for r in runs.overfit_table(df).orderBy("run_name").collect()] == ["overfit", "acceptable", "well fitted", "underfit"]


def test_imputation(spark):
    df = spark.createDataFrame([(1.0, None), (None, 1), (3.0, 0), (10.0, None)], "v double, flag int")
    exact = models.impute_exact(df, ["v"], ["flag"]).collect()
    assert exact[1]["v"] == 3.0 and [r["flag"] for r in exact] == [0, 1, 0, 0]
    assert models.impute(df, ["v"], ["flag"]).collect()[1]["v"] == 3.0


def test_save_reload_and_refit(line, tmp_path):
    raw = line.drop("features")
    stages = [*models.assemble(["a", "b"]).getStages(), models.regressor("LinearRegression")]
    fitted = models.refit(models.Pipeline(stages=stages), raw)
    copy, sample = models.save_and_reload(fitted, str(tmp_path / "model"), raw.where("split = 'test'"))
    assert sample.count() == 5
    a = models.score(copy, raw).select("key", "prediction").orderBy("key").collect()
    assert a == models.score(fitted, raw).select("key", "prediction").orderBy("key").collect()


def test_split_record(line, spark, tmp_path):
    files.save_json(files.feature_record(line, ["a", "b"], "label", "no leakage"), str(tmp_path / "r"))
    row = spark.read.json(str(tmp_path / "r")).first()
    assert (row["n_features"], row["train_samples"], row["val_samples"], row["test_samples"]) == (2, 200, 50, 50)
    files.save_splits(line.drop("features"), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).where("split = 'val'").count() == 50


def test_comparisons_rank_and_show_refused_settings(line):
    from salescope.learn import compare

    data = line.drop("features").withColumn("split", F.when(F.col("split") == "test", "test").otherwise("train"))
    chosen = {"Linear Regression": ("LinearRegression", {}), "Broken": ("Nothing", {}), "KNN Regression": ("KNN", {"n_neighbors": 3})}
    rows = compare.compare_forecasters(data, ["a", "b"], "key", ["key"], 7, chosen).collect()
    got = [r["model_name"] for r in rows]
    assert got[:2] == ["Linear Regression", "KNN Regression"] and set(got[2:4]) == {"Naive Baseline", "Moving Average"}
    assert got[4:] == ["Broken"] and rows[4]["rmse"] is None
    labelled = data.withColumn("label", (F.col("label") > 5).cast("double"))
    best = compare.compare_classifiers(labelled, ["a", "b"], "key", chosen={"Logistic Regression": "LogisticRegression", "KNN": "KNN"}).collect()
    assert len(best) == 2 and best[0]["f1"] >= best[1]["f1"] > 0.9


def test_promotion_comparison_trains_every_classifier(spark, tmp_path, monkeypatch):
    from salescope.learn import compare
    from salescope.plans import models as plans

    rows = [(i, f"Brand#{i % 5}", "PROMO" if i % 3 == 0 else "ECONOMY", i % 50, 900.0 + i % 7) for i in range(80)]
    spark.createDataFrame(rows, "p_partkey long, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    made, make = {}, models.classifier

    def small(kind, classes, width, trees, depth):
        whole = make(kind, classes, width, trees, depth)
        made[kind] = [whole.getOrDefault(p) for p in ("maxDepth", "numTrees", "maxIter") if whole.hasParam(p)]
        return make(kind, classes, width, 2, 2)

    monkeypatch.setattr(models, "classifier", small)
    got = plans.promotion_classifier_comparison(spark, str(tmp_path)).collect()
    assert {r["model_name"] for r in got} == set(compare.CLASSIFIERS) and all(r["f1"] > 0 for r in got)
    assert made == {"LogisticRegression": [1000], "NaiveBayes": [], "DecisionTree": [10], "RandomForest": [10, 100], "BoostedTrees": [5, 100]}


def test_models_of_depth_one_are_fitted_on_few_weighted_rows(spark, monkeypatch):
    from pyspark.ml.regression import DecisionTreeRegressor

    from salescope.plans import learners

    rows = spark.range(3000).select(
        (F.col("id") % 14 + 9).cast("double").alias("hour"), (F.col("id") % 7 + 1).cast("double").alias("day"),
        (F.col("id") % 14 * 3 + F.col("id") % 11).cast("double").alias("label"), F.when(F.col("id") % 5 < 4, "train").otherwise("test").alias("split"))
    seen, original = [], DecisionTreeRegressor.fit
    monkeypatch.setattr(DecisionTreeRegressor, "fit", lambda self, data: seen.append(data.count()) or original(self, data))
    got = {(r["model_name"], r["split"]): r for r in learners.depth_one_metrics(rows).collect()}
    assert seen[0] <= 14 * 7 and len(got) == 8
    p = rows.toPandas()
    train = p[p.split == "train"]
    cut = max((c + 0.5 for c in range(9, 22)), key=lambda c: len(train[train.hour < c]) * len(train[train.hour > c])
              * (train[train.hour < c].label.mean() - train[train.hour > c].label.mean()) ** 2)
    for name in ("DecisionTree", "RandomForest", "BoostedTrees_1"):
        for split, part in p.groupby("split"):
            guess = (part.hour < cut).map({True: train[train.hour < cut].label.mean(), False: train[train.hour > cut].label.mean()})
            assert got[name, split]["mae"] == pytest.approx((part.label - guess).abs().mean(), abs=1e-3)


def test_many_lines_are_stored_as_assembled_columns(spark, tmp_path, monkeypatch):
    from salescope.plans import models as plans

    lines = [(i % 20, i % 7, i, float(1 + i % 5), float(10 + i % 9)) for i in range(200)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT id AS o_orderkey, id AS o_custkey, timestamp'2024-01-01' + make_interval(0, 0, 0, int(id)) AS o_orderdate FROM range(20)").write.parquet(
        f"{tmp_path}/orders.parquet")
    spark.sql("SELECT id AS p_partkey, concat('red ', id) AS p_name, 'b' AS p_brand, 'PROMO' AS p_type, int(id) AS p_size FROM range(7)").write.parquet(
        f"{tmp_path}/part.parquet")
    assembler = models.assemble(models.REVENUE_NUMERIC).getStages()[0]

    def rows(data):
        return sorted((r["all_features"].toArray().tolist(), r["label"], r["split"]) for r in data.collect())

    whole = rows(plans.revenue_data(spark, str(tmp_path), assembler))
    monkeypatch.setattr(plans, "FEW_LINES", 0)
    data = plans.revenue_data(spark, str(tmp_path), assembler)
    assert data.columns == ["all_features", "label", "split"] and data.inputFiles()
    assert len(whole) == 200 and rows(data) == whole
    summed, cells_of = [], models.cells_of

    def counted(train, features):
        cells = cells_of(train, features)
        summed.append((train.count(), *cells.agg(F.sum("rows"), F.sum(F.col("rows") * F.col("label"))).first()))
        return cells

    monkeypatch.setattr(models, "cells_of", counted)
    got = {r["split"]: r["rmse"] for r in plans.revenue_boosted_trees(spark, str(tmp_path)).collect()}
    assert set(got) == {"train", "val", "test"} and all(x >= 0 for x in got.values())
    assert summed == [(n := sum(r[2] == "train" for r in whole), n, pytest.approx(sum(r[1] for r in whole if r[2] == "train")))]


def test_trees_learn_the_same_from_cells_as_from_rows(spark):
    rng = np.random.default_rng(3)
    x = np.stack([np.arange(900) % 5, rng.random(900).round(3), np.arange(900) % 2], 1)
    y = 3 * x[:, 0] + np.sin(6 * x[:, 1]) + rng.normal(size=900)
    rows = spark.createDataFrame([(*map(float, v), float(w), i) for i, (v, w) in enumerate(zip(x, y))], "a double, b double, c double, label double, key int")
    data = models.VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)
    borders = models.tree_borders(data, "features", 3)
    assert list(borders) == [1] and 2 <= len(borders[1]) < models.BINS
    data = models.binned(data, "features", 3, borders).cache()
    codes = np.array([r["features"].toArray() for r in data.orderBy("key").collect()])
    assert (codes == np.stack([x[:, 0], np.searchsorted(borders[1], x[:, 1], "right"), x[:, 2]], 1)).all()
    cells = models.cells_of(data, "features")
    assert cells.count() < 350 and cells.agg(F.sum("rows")).first()[0] == 900
    grown = models.regressor("BoostedTrees", n_estimators=4, max_depth=4, learning_rate=0.2)
    usual, merged = grown.fit(data), grown.copy().setWeightCol("rows").fit(cells)
    both = [[r["prediction"] for r in m.transform(data).orderBy("key").collect()] for m in (usual, merged)]
    assert both[1] == pytest.approx(both[0]) and len(set(both[0])) > 10
    none = data.withColumn("label", F.when(F.col("key") > 0, F.col("label")))
    assert models.cells_of(none, "features").where(F.isnan("label")).count() == 1
