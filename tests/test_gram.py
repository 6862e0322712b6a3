import numpy as np
import pytest
from pyspark.sql import functions as F

from salescope.learn import gram, models

RNG = np.random.default_rng(11)
X = np.concatenate([RNG.normal(size=(400, 3)) * [1, 20, 0.1] + [5, -300, 0], np.full((400, 1), 7.0)], 1)
KINDS = RNG.integers(0, 5, 400)
Y = X[:, 0] * 3 - X[:, 1] * 0.2 + np.array([0, 4, -9, 2, 30.0])[KINDS] + RNG.normal(size=400)
SPLIT = np.where(np.arange(400) % 10 < 7, "train", np.where(np.arange(400) % 10 < 8, "val", "test"))


@pytest.fixture(scope="module")
def data(spark):
    rows = [(*map(float, x), f"k{k}" if k else None, float(y), s) for x, k, y, s in zip(X, KINDS, Y, SPLIT)]
    return spark.createDataFrame(rows, "a double, b double, c double, flat double, kind string, label double, split string").repartition(5)


def dense(spark, data, design):
    """The inputs as the matrix has them, and the label and split, in one order."""
    rows = data.select(*design.columns("label", "split")).toPandas()
    wide = [design.numbers(rows)] + [np.eye(w)[codes] for w, codes in zip(design.categories.values(), design.codes(rows).values())]
    return np.concatenate(wide, 1), rows["_y"].to_numpy(), rows["split"].to_numpy()


def test_matrix_is_the_gram_matrix(spark, data):
    design = gram.Design(["a", "b", "c", "flat"], {"kind": 7, "split": 3})
    got = gram.matrices(data, design)
    x, y, split = dense(spark, data, design)
    for s in gram.SPLITS:
        whole = np.column_stack([np.ones(len(y)), x, y])[split == s]
        assert got[s] == pytest.approx(whole.T @ whole, rel=1e-9)


def test_every_model_is_optimal(spark, data):
    """Slopes of the loss at each solution, on the rows: zero, or bounded where a weight is at zero."""
    design = gram.Design(["a", "b", "c", "flat"], {"kind": 64})
    grid = {k: models.REGRESSION_GRID[k] for k in gram.KINDS}
    x, y, split = dense(spark, data, design)
    x, y = x[split == "train"], y[split == "train"]
    rows = gram.linear_grid(data, design, grid)
    assert len(rows) == 24
    for row in rows:
        p, model = {k: eval(v) for k, v in row["params"].items()}, row["model"]
        w, kind = model.weights, row["model_name"]
        error = y - model.intercept - x @ w
        if p.get("fit_intercept", True):
            assert abs(error.mean()) < 1e-8
        else:
            assert model.intercept == 0
        slope = x.T @ error
        alpha, l1 = p.get("alpha", 0.0), p.get("l1_ratio", 1.0)
        bound, curve = (len(y) * alpha * l1, len(y) * alpha * (1 - l1)) if kind in ("Lasso", "ElasticNet") else (0.0, alpha if kind == "Ridge" else 0.0)
        slope = slope - curve * w
        size = 1e-7 * (1 + np.abs(x).sum(0) * np.abs(y).max())
        free = w != 0
        assert (np.abs(slope - bound * np.sign(w))[free] < size[free]).all(), row["run_name"]
        if p.get("positive"):
            assert (w >= 0).all() and (slope[~free] < size[~free]).all() and (w[1] == 0 and not free.all())
        else:
            live = ~free & (x.std(0) > 0)
            assert (np.abs(slope[live]) <= bound + size[live]).all()


def test_errors_from_the_matrix_and_from_rows_agree(spark, data):
    design = gram.Design(["a", "b", "c"], {"kind": 64})
    rows = gram.linear_grid(data, design, {"Ridge": {"alpha": [2.0]}, "LinearRegression": {"fit_intercept": [False]}})
    x, y, split = dense(spark, data, design)
    for row in rows:
        for s in gram.SPLITS:
            wrong = (y - row["model"].intercept - x @ row["model"].weights)[split == s]
            assert row[f"{s}_rmse"] == pytest.approx(np.sqrt((wrong**2).mean()))
            assert row[f"{s}_mae"] == pytest.approx(np.abs(wrong).mean())
            assert row[f"{s}_r2"] == pytest.approx(1 - (wrong**2).mean() / y[split == s].var())
    scored = gram.predictions(data, design, {"p": rows[0]["model"]}, ["split", "kind", "label"])
    rmse = {r["split"]: r["e"] for r in scored.groupBy("split").agg(F.sqrt(F.avg((F.col("label") - F.col("p")) ** 2)).alias("e")).collect()}
    assert all(rmse[s] == pytest.approx(rows[0][f"{s}_rmse"]) for s in gram.SPLITS)


def test_non_negative_against_all_supports():
    rng = np.random.default_rng(1)
    for _ in range(30):
        x, y = rng.normal(size=(30, 5)), rng.normal(size=30)
        a, b = x.T @ x, x.T @ y
        best = min((((y - x[:, s] @ w) ** 2).sum(), tuple(s)) for m in range(32) for s in [[i for i in range(5) if m >> i & 1]]
                   for w in [np.linalg.solve(a[np.ix_(s, s)], b[s])] if (w >= -1e-12).all())[0]
        got = gram.non_negative(a, b)
        assert (got >= 0).all() and ((y - x @ got) ** 2).sum() == pytest.approx(best)


def test_collinear_inputs_and_empty_splits(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 5.0 * i + 1, "train") for i in range(9)] + [(None, 1.0, None, "val")], "a double, b double, label double, split string")
    rows = gram.linear_grid(df, gram.Design(["a", "b"]), {"LinearRegression": {"fit_intercept": [True]}})
    assert rows[0]["train_rmse"] == pytest.approx(0, abs=1e-6) and rows[0]["val_rmse"] is None
