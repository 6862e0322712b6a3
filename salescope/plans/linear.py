"""Grids of linear models from one Gram matrix, and their ensembles."""

from __future__ import annotations

import itertools

from pyspark.sql import Window as W, functions as F

from salescope.learn import gram, models, runs
from salescope.learn.store import RunStore
from salescope.operators import series
from salescope.operators.series import best_rows
from salescope.plans.profiles import SPLIT_CASE, SPLIT_KEYS
from salescope.plans.registry import SALES, R, query, rounded, sql
from salescope.session import scratch_path
from salescope.sources.views import sales

GRID = {k: models.REGRESSION_GRID[k] for k in gram.KINDS}
METRICS = ("rmse", "mae", "r2")
#: Steps of coordinate descent in the SQL; two inputs settle in far fewer.
STEPS = 100


def grid_sql(columns: tuple[str, str], label: str, grid: dict) -> list[str]:
    """CTEs up to ``scored``: every configuration by coordinate descent on two inputs, fitted on the train split."""
    rows = []
    for kind, options in grid.items():
        for number, p in enumerate(models.combinations(options), 1):
            alpha, l1 = p.get("alpha", 0.0), p.get("l1_ratio", 1.0) if kind in ("Lasso", "ElasticNet") else 0.0
            by_row, whole = (alpha * (1 - l1), 0.0) if kind in ("Lasso", "ElasticNet") else (0.0, alpha)
            rows.append(f"('{models.run_name(kind, p)}', '{kind}', {number}, {int(p.get('fit_intercept', True))}, {bool(p.get('positive', False))}, "
                        f"{alpha * l1}::DOUBLE, {by_row}::DOUBLE, {whole}::DOUBLE)")
    return [
        f"t AS (SELECT CAST({columns[0]} AS DOUBLE) AS x1, CAST({columns[1]} AS DOUBLE) AS x2, CAST({label} AS DOUBLE) AS y, {SPLIT_CASE} AS split FROM sales)",
        f"p(run_name, kind, number, fit, pos, share1, share2, alone2) AS (VALUES {', '.join(rows)})",
        *solved_sql("", "split = 'train'"),
    ]


def solved_sql(tag: str, rows: str) -> list[str]:
    """The configurations ``p`` solved on some rows of ``t``, and their errors on all splits."""
    step = "(CASE WHEN pos THEN greatest({z}, 0) ELSE sign({z}) * greatest(abs({z}) - l1, 0) END / ({a} + l2))"
    one, two = step.format(z="(c1 - a12 * w2)", a="a11"), step.format(z="(c2 - a12 * n1)", a="a22")
    return [
        f"""s{tag} AS (SELECT count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, sum(x1 * x1) AS s11, sum(x1 * x2) AS s12, sum(x2 * x2) AS s22,
              sum(x1 * y) AS s1y, sum(x2 * y) AS s2y FROM t WHERE {rows})""",
        f"""g{tag} AS (SELECT run_name, kind, number, fit, pos, n * share1 AS l1, n * share2 + alone2 AS l2, m1, m2, my, s11 - fit * n * m1 * m1 AS a11,
              s12 - fit * n * m1 * m2 AS a12, s22 - fit * n * m2 * m2 AS a22, s1y - fit * n * m1 * my AS c1, s2y - fit * n * m2 * my AS c2 FROM p, s{tag})""",
        f"""cd{tag} AS (SELECT run_name, 0 AS k, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2 FROM g{tag} UNION ALL
              SELECT run_name, k + 1, n1, {two} FROM (SELECT c.run_name, k, g.* EXCLUDE (run_name), {one} AS n1 FROM cd{tag} c JOIN g{tag} g USING (run_name) WHERE k < {STEPS}))""",
        f"best{tag} AS (SELECT run_name, kind, number, w1, w2, fit * (my - m1 * w1 - m2 * w2) AS w0 FROM cd{tag} JOIN g{tag} USING (run_name) WHERE k = {STEPS})",
        f"""scored{tag} AS (SELECT run_name, kind, number, w0, w1, w2, split, sqrt(avg(power(y - w0 - w1 * x1 - w2 * x2, 2))) AS rmse,
              avg(abs(y - w0 - w1 * x1 - w2 * x2)) AS mae, 1 - sum(power(y - w0 - w1 * x1 - w2 * x2, 2)) / (var_pop(y) * count(*)) AS r2
              FROM t, best{tag} GROUP BY ALL)""",
    ]


def split_lines(spark, d, *columns):
    return series.random_split(sales(spark, d, *SPLIT_KEYS, *columns), SPLIT_KEYS)


def long_rows(spark, rows: list[dict], weights: int = 2):
    """One row for each run and split."""
    out = [
        (r["run_name"], s, *[r[f"{s}_{m}"] for m in METRICS], r["model"].intercept, *[float(w) for w in r["model"].weights[:weights]])
        for r in rows for s in gram.SPLITS
    ]
    names = ", ".join(f"w{i + 1} double" for i in range(weights))
    return rounded(spark.createDataFrame(out, f"run_name string, split string, rmse double, mae double, r2 double, w0 double, {names}"), 4)


LONG = ", ".join(f"{R(c, 4)} AS {c}" for c in ("rmse", "mae", "r2", "w0", "w1", "w2"))


@query("line_linear_grid", sql(SALES, *grid_sql(("quantity", "unit_price"), "total_price", GRID), recursive=True, select=f"SELECT run_name, split, {LONG} FROM scored"))
def line_linear_grid(spark, d):
    """All linear configurations of line revenue on quantity and unit price."""
    data = split_lines(spark, d, "quantity", "unit_price", "total_price")
    return long_rows(spark, gram.linear_grid(data, gram.Design(["quantity", "unit_price"]), GRID, "total_price"))


POSITIVE = {"LinearRegression": GRID["LinearRegression"]}


@query("positive_regression", sql(SALES, *grid_sql(("quantity", "hour"), "unit_price", POSITIVE), recursive=True, select=f"SELECT run_name, split, {LONG} FROM scored"))
def positive_regression(spark, d):
    """Unit price on quantity, which lowers it, and hour: the weight of quantity is at its bound if weights must be positive."""
    data = split_lines(spark, d, "quantity", "order_time", "unit_price").withColumn("hour", F.substring("order_time", 1, 2).cast("int"))
    return long_rows(spark, gram.linear_grid(data, gram.Design(["quantity", "hour"]), POSITIVE, "unit_price"))


ENSEMBLES = list(itertools.product((3, 5), ("uniform", "inverse_rmse"), (False, True)))


def ensembles(spark, rows: list[dict], data, design: gram.Design, label: str, diverse: bool = False):
    """Run table of the eight ensembles of the best runs by validation error.

    A weighted mean of linear models is one linear model, so all ensembles are scored by the same two passes as the runs.
    """
    names = [f.split()[0] for f in models.RUN_SCHEMA.replace("map<string,string>", "map").split(", ")]
    table = spark.createDataFrame([tuple(r[c] for c in names) for r in rows], models.RUN_SCHEMA).withColumn("val_rmse", F.round("val_rmse", 6))
    by_name = {r["run_name"]: r["model"] for r in rows}
    made = {}
    for n, weighting, scaled in ENSEMBLES:
        chosen = runs.ensemble_weights(runs.top_runs(table, n, diverse=diverse), weighting, div_by_std=scaled).select("run_name", "weight").collect()
        made[f"Ensemble_n{n}_{weighting}_div{scaled}"] = gram.LinearModel(
            sum(c["weight"] * by_name[c["run_name"]].intercept for c in chosen), sum(c["weight"] * by_name[c["run_name"]].weights for c in chosen))
    at, wrong = gram.matrices(data, design, label), gram.absolute_errors(data, design, list(made.values()), label)
    out = [(name, s, *(lambda e: (e[0], float(wrong[s][k]), e[1]))(model.errors(at[s]))) for k, (name, model) in enumerate(made.items()) for s in gram.SPLITS]
    return rounded(spark.createDataFrame(out, "run_name string, split string, rmse double, mae double, r2 double"), 4)


def ensemble_sql(diverse: bool) -> str:
    pool = "QUALIFY row_number() OVER (PARTITION BY kind ORDER BY round(rmse, 6), run_name) = 1" if diverse else ""
    made = ", ".join(f"({n}, '{w}', 'Ensemble_n{n}_{w}_div{s}')" for n, w, s in ENSEMBLES)
    return sql(
        SALES, *grid_sql(("quantity", "unit_price"), "total_price", GRID),
        f"pool AS (SELECT * FROM scored WHERE split = 'val' {pool})",
        "ranked AS (SELECT *, row_number() OVER (ORDER BY round(rmse, 6), run_name) AS place FROM pool)",
        f"e(n, weighting, name) AS (VALUES {made})",
        """raw AS (SELECT name, w0, w1, w2, CASE WHEN weighting = 'uniform' THEN 1.0::DOUBLE ELSE 1 / round(rmse, 6) END AS weight FROM e JOIN ranked ON place <= n)""",
        """mixed AS (SELECT name, sum(weight * w0) / sum(weight) AS w0, sum(weight * w1) / sum(weight) AS w1, sum(weight * w2) / sum(weight) AS w2 FROM raw GROUP BY 1)""",
        recursive=True, select=f"""
        SELECT name AS run_name, split, {R('sqrt(avg(power(y - w0 - w1 * x1 - w2 * x2, 2)))', 4)} AS rmse, {R('avg(abs(y - w0 - w1 * x1 - w2 * x2))', 4)} AS mae,
          {R('1 - sum(power(y - w0 - w1 * x1 - w2 * x2, 2)) / (var_pop(y) * count(*))', 4)} AS r2 FROM t, mixed GROUP BY 1, 2""")


def line_ensembles(spark, d, diverse):
    data, design = split_lines(spark, d, "quantity", "unit_price", "total_price"), gram.Design(["quantity", "unit_price"])
    rows = gram.linear_grid(data, design, GRID, "total_price")
    return ensembles(spark, rows, data, design, "total_price", diverse)


@query("line_linear_ensembles", ensemble_sql(False))
def line_linear_ensembles(spark, d):
    return line_ensembles(spark, d, False)


@query("line_diverse_ensembles", ensemble_sql(True))
def line_diverse_ensembles(spark, d):
    """One run of each kind of model."""
    return line_ensembles(spark, d, True)


def run_rows(spark, rows: list[dict], **columns):
    """Run table rows with constant columns added."""
    names = [f.split()[0] for f in models.RUN_SCHEMA.replace("map<string,string>", "map").split(", ")]
    table = spark.createDataFrame([tuple(r[c] for c in names) for r in rows], models.RUN_SCHEMA)
    return table.withColumns({k: F.lit(v) for k, v in columns.items()}).withColumn("run_id", F.concat_ws("/", *columns, "run_name"))


@query(
    "champion_refit_and_export",
    sql(SALES, *grid_sql(("quantity", "unit_price"), "total_price", GRID), *solved_sql("_again", "split <> 'test'"),
        "champion AS (SELECT run_name FROM scored WHERE split = 'val' ORDER BY round(rmse, 6), number, run_name LIMIT 1)", recursive=True,
        select=f"""SELECT run_name, kind AS model_name, {R('w0', 4)} AS intercept, {R('w1', 4)} AS quantity, {R('w2', 4)} AS unit_price, {R('rmse', 4)} AS test_rmse,
          {R('mae', 4)} AS test_mae, {R('r2', 4)} AS test_r2 FROM scored_again JOIN champion USING (run_name) WHERE split = 'test'"""),
)
def champion_refit_and_export(spark, d):
    """The runs are stored, the champion is looked up there, fitted again on train and validation rows and exported as JSON; the export is read back."""
    data, design = split_lines(spark, d, "quantity", "unit_price", "total_price"), gram.Design(["quantity", "unit_price"])
    store = RunStore(spark, scratch_path(spark, "runs"))
    rows = gram.linear_grid(data, design, GRID, "total_price")
    for kind in GRID:  # a write for each kind of model, as separate scripts would do it
        store.append(run_rows(spark, [r for r in rows if r["model_name"] == kind], experiment="line_revenue"))
    held = store.read().where(F.col("experiment") == "line_revenue").withColumn("val_rmse", F.round("val_rmse", 6))
    best = runs.champion(held).first()
    exported = gram.export(spark, data, design, best["model_name"], best["params"], scratch_path(spark, "production"), "total_price", best["run_name"])
    config = spark.read.json(exported)
    weights = [F.element_at("weights", i + 1).alias(c) for i, c in enumerate(design.numeric)]
    return rounded(config.select("run_name", "model_name", "intercept", *weights, "test.*"), 4)


@query(
    "stored_run_table",
    sql(SALES, *grid_sql(("quantity", "unit_price"), "total_price", GRID), recursive=True, select=f"""
        SELECT kind AS model_name, run_name, {R('rmse', 4)} AS val_rmse, CAST(row_number() OVER (PARTITION BY kind ORDER BY round(rmse, 6), run_name) AS INTEGER) AS place
        FROM scored WHERE split = 'val' AND kind <> 'Lasso' QUALIFY place <= 3"""),
)
def stored_run_table(spark, d):
    """Runs appended by kind; retention then drops all lasso runs in a rewrite; the best three of each kind come from the table."""
    data = split_lines(spark, d, "quantity", "unit_price", "total_price")
    store = RunStore(spark, scratch_path(spark, "runs"))
    rows = gram.linear_grid(data, gram.Design(["quantity", "unit_price"]), GRID, "total_price")
    for i, kind in enumerate(GRID):
        store.append(run_rows(spark, [r for r in rows if r["model_name"] == kind], experiment="line_revenue", started=i))
    store.retain(buckets=[("lasso", ["lasso"], 0)])
    best = best_rows(store.read().withColumn("val_rmse", F.round("val_rmse", 6)), ["model_name"], F.col("val_rmse"), F.col("run_name"), n=3)
    place = F.row_number().over(W.partitionBy("model_name").orderBy("val_rmse", "run_name"))
    return rounded(best.select("model_name", "run_name", "val_rmse", place.alias("place")), 4)


#: Hashed inputs of each category.
WIDTHS = {"category": 64, "item_size": 64, "item_name": 4096}
LINES = gram.Design(models.REVENUE_NUMERIC, WIDTHS)


@query("revenue_linear_model")
def revenue_linear_model(spark, d):
    """Line revenue from leak-free features, categories hashed."""
    data = models.revenue_features(sales(spark, d))
    rows = gram.linear_grid(data, LINES, {"LinearRegression": {"fit_intercept": [True]}})
    return spark.createDataFrame([(s, *[rows[0][f"{s}_{m}"] for m in METRICS]) for s in gram.SPLITS], "split string, rmse double, mae double, r2 double")


def grid_table(spark, d, target: str):
    rows = gram.linear_grid(models.revenue_features(sales(spark, d), target), LINES, GRID)
    names = [f.split()[0] for f in models.RUN_SCHEMA.replace("map<string,string>", "map").split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], models.RUN_SCHEMA).drop("training_time")


@query("revenue_linear_grid")
def revenue_linear_grid(spark, d):
    return grid_table(spark, d, "total_price")


@query("quantity_linear_grid")
def quantity_linear_grid(spark, d):
    return grid_table(spark, d, "quantity")
