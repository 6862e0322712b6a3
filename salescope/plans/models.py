"""Model training, metrics, ensembles and run-table queries."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from salescope.learn import baselines, compare, metrics, models, runs
from salescope.operators import series
from salescope.operators.neighbours import knn_classification, knn_regression
from salescope.plans.demand import LAGS, SPLIT, hourly, split_hours
from salescope.plans.profiles import SPLIT_CASE, SPLIT_KEYS
from salescope.plans.registry import HOURLY, R, SALES, query, r, rounded, sql
from salescope.session import cut_lineage, fixed_and_spread, scratch_path, stored
from salescope.sources.views import sales, table

SETS = ("train", "val", "test")


def baseline(spark, d):
    """Predictions of all baselines for the hourly event counts (eight rows an hour)."""
    return baselines.predictions(split_hours(spark, d))


def baseline_runs(spark, d):
    return cut_lineage(baselines.run_table(baseline(spark, d)))


def _mean(keys: str) -> str:
    return f"coalesce(avg(CASE WHEN split = 'train' THEN units END) OVER ({f'PARTITION BY {keys}' if keys else ''}), avg(CASE WHEN split = 'train' THEN units END) OVER ())"


def _moving(w: int) -> str:
    return f"coalesce(avg(units) OVER (ORDER BY date, hour ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING), avg(CASE WHEN split = 'train' THEN units END) OVER ())"


BASELINE_COLUMNS = [
    ("MeanByKey", 1, "MeanByKey_key=all", _mean("")),
    ("MeanByKey", 2, "MeanByKey_key=hour", _mean("hour")),
    ("MeanByKey", 3, "MeanByKey_key=weekday", _mean("isodow(date)")),
    ("MeanByKey", 4, "MeanByKey_key=hour_weekday", _mean("hour, isodow(date)")),
    ("MovingAverage", 1, "MovingAverage_window=3", _moving(3)),
    ("MovingAverage", 2, "MovingAverage_window=7", _moving(7)),
    ("MovingAverage", 3, "MovingAverage_window=24", _moving(24)),
    ("LastValue", 1, "LastValue_shift=1",
     "coalesce(lag(units) OVER (ORDER BY date, hour), avg(CASE WHEN split = 'train' THEN units END) OVER ())"),
]
BASELINE = "\nbase AS (" + " UNION ALL ".join(
    f"SELECT date, hour, split, CAST(units AS DOUBLE) AS label, '{m}' AS model_name, {n} AS config_num, '{name}' AS run_name, CAST({expr} AS DOUBLE) AS prediction FROM split"
    for m, n, name, expr in BASELINE_COLUMNS
) + ")"
METRICS = """
scores AS (
  SELECT model_name, config_num, run_name, split, sqrt(avg((label - prediction) * (label - prediction))) AS rmse, avg(abs(label - prediction)) AS mae,
         1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*)) AS r2,
         avg(abs((label - prediction) / label)) * 100 AS mape FROM base GROUP BY 1, 2, 3, 4)"""
RUNS = "\nruns AS (SELECT model_name, config_num, run_name, " + ", ".join(
    f"max(CASE WHEN split = '{s}' THEN {m} END) AS {s}_{m}" for s in SETS for m in ("rmse", "mae", "r2")
) + " FROM scores GROUP BY 1, 2, 3)"
BASE = (HOURLY, SPLIT, BASELINE, METRICS, RUNS)
RUN_METRICS = ", ".join(f"{R(f'{s}_{m}')} AS {s}_{m}" for s in SETS for m in ("rmse", "mae", "r2"))


@query(
    "baseline_predictions",
    sql(HOURLY, SPLIT, BASELINE, select=f"SELECT CAST(date AS VARCHAR) AS date, hour, split, label, run_name, {R('prediction')} AS prediction FROM base"),
)
def baseline_predictions(spark, d):
    return rounded(baseline(spark, d).select("date", "hour", "split", "label", "run_name", "prediction"))


@query("baseline_runs", sql(*BASE, select=f"SELECT model_name, config_num, run_name, {RUN_METRICS} FROM runs"))
def baseline_runs_query(spark, d):
    return rounded(baselines.run_table(baseline(spark, d)))


@query(
    "regression_metrics",
    sql(*BASE, select=f"SELECT run_name, split, {R('rmse')} AS rmse, {R('mae')} AS mae, {R('r2')} AS r2, {R('mape')} AS mape FROM scores"),
)
def regression_metrics(spark, d):
    parts = {**metrics.regression_columns(), "mape": metrics.mape()}
    return rounded(baseline(spark, d).groupBy("run_name", "split").agg(*[c.alias(n) for n, c in parts.items()]))


@query(
    "guarded_percentage_error",
    sql(HOURLY, SPLIT, BASELINE, select=f"SELECT run_name, {R('avg(abs((label - 10 - prediction) / (label - 10 + 0.5))) * 100', 2)} AS mape FROM base GROUP BY 1"),
)
def guarded_percentage_error(spark, d):
    shifted = baseline(spark, d).withColumn("label", F.col("label") - 10)
    return shifted.groupBy("run_name").agg(r(metrics.mape(guard=0.5), 2).alias("mape"))


@query("ranked_runs", sql(*BASE, select=f"SELECT run_name, {R('test_rmse')} AS test_rmse FROM runs WHERE model_name = 'MeanByKey' ORDER BY runs.test_rmse"))
def ranked_runs(spark, d):
    return runs.ranked_runs(baseline_runs(spark, d), model_name="MeanByKey").select("run_name", r("test_rmse").alias("test_rmse"))


@query(
    "combined_runs",
    sql(*BASE, select=f"""
        SELECT model_name, run_name, {R('val_rmse')} AS val_rmse, 'base' AS origin, 'none' AS weighting FROM runs
        UNION ALL SELECT 'Ensemble', 'Ensemble_' || model_name, {R('avg(val_rmse)')}, 'ensemble', 'uniform' FROM runs GROUP BY model_name"""),
)
def combined_runs(spark, d):
    base = baseline_runs(spark, d).select("model_name", "run_name", "val_rmse", F.lit("base").alias("origin"))
    extra = base.groupBy("model_name").agg(F.avg("val_rmse").alias("val_rmse")).select(
        F.lit("Ensemble").alias("model_name"), F.concat(F.lit("Ensemble_"), "model_name").alias("run_name"), "val_rmse",
        F.lit("ensemble").alias("origin"), F.lit("uniform").alias("weighting"),
    )
    return rounded(runs.combined(base, extra)).fillna("none", ["weighting"])


@query("base_runs_only", sql(*BASE, select="SELECT model_name, count(*) AS runs FROM runs WHERE model_name <> 'LastValue' GROUP BY 1"))
def base_runs_only(spark, d):
    tagged = baseline_runs(spark, d).withColumn("model_name", F.when(F.col("model_name") == "LastValue", "Ensemble").otherwise(F.col("model_name")))
    return runs.without_ensembles(tagged).groupBy("model_name").agg(F.count(F.lit(1)).alias("runs"))


@query(
    "champion_run",
    sql(*BASE, select=f"""
        (SELECT 'val_rmse' AS rule, run_name, {R('val_rmse')} AS score FROM runs ORDER BY runs.val_rmse, config_num, run_name LIMIT 1)
        UNION ALL (SELECT 'test_r2', run_name, {R('test_r2')} FROM runs ORDER BY runs.test_r2 DESC, config_num, run_name LIMIT 1)"""),
)
def champion_run(spark, d):
    table_ = baseline_runs(spark, d)
    by_rmse = runs.champion(table_).select(F.lit("val_rmse").alias("rule"), "run_name", r("val_rmse").alias("score"))
    return by_rmse.unionByName(
        runs.champion(table_, "test_r2", ascending=False).select(F.lit("test_r2").alias("rule"), "run_name", r("test_r2").alias("score"))
    )


@query(
    "diverse_top_runs",
    sql(*BASE, select=f"""
        SELECT model_name, run_name, {R('val_rmse')} AS val_rmse FROM
        (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY val_rmse, run_name) = 1) ORDER BY 3, 2 LIMIT 3"""),
)
def diverse_top_runs(spark, d):
    return runs.top_runs(baseline_runs(spark, d), 3, diverse=True).select("model_name", "run_name", r("val_rmse").alias("val_rmse"))


@query(
    "overfit_table",
    sql(*BASE, select=f"""
        SELECT run_name, {R('train_r2 - test_r2')} AS gap, CASE WHEN train_r2 < 0.5 AND test_r2 < 0.5 THEN 'underfit' WHEN train_r2 - test_r2 > 0.01 THEN 'overfit'
          WHEN train_r2 - test_r2 > 0 THEN 'acceptable' ELSE 'well fitted' END AS verdict FROM runs"""),
)
def overfit_table(spark, d):
    return rounded(runs.overfit_table(baseline_runs(spark, d)).select("run_name", "gap", "verdict"))


def weights_sql(n: int, weighting: str) -> str:
    raw = "1.0" if weighting == "uniform" else "1 / (val_rmse + 1e-10)"
    return f"""
top AS (SELECT *, {raw} AS raw FROM runs ORDER BY val_rmse, run_name LIMIT {n}),
weights AS (SELECT run_name, raw / sum(raw) OVER () AS weight FROM top)"""


@query("ensemble_weights", sql(*BASE, weights_sql(5, "inverse_rmse"), select=f"SELECT run_name, {R('weight', 8)} AS weight FROM weights"))
def ensemble_weights(spark, d):
    chosen = runs.top_runs(baseline_runs(spark, d), 5)
    got = runs.ensemble_weights(chosen, "inverse_rmse", 1e-10, div_by_std=True)
    return got.select("run_name", r("weight", 8).alias("weight"))


BLEND = """
blend AS (SELECT date, hour, split, max(label) AS label, sum(weight * prediction) AS prediction FROM base JOIN weights USING (run_name) GROUP BY 1, 2, 3)"""
BLEND_METRICS = f"""split, {R('sqrt(avg((label - prediction) * (label - prediction)))')} AS rmse, {R('avg(abs(label - prediction))')} AS mae,
  {R('1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*))')} AS r2 FROM blend GROUP BY split"""


def _blend(spark, d, n, weighting, diverse=False):
    predictions = baseline(spark, d)
    chosen = runs.top_runs(cut_lineage(baselines.run_table(predictions)), n, diverse=diverse)
    weights = runs.ensemble_weights(chosen, weighting, 1e-10)
    blended = runs.blend_long(predictions, weights, ["date", "hour", "split", "label"])
    return rounded(metrics.regression_metrics(blended))


@query("ensemble_inverse_rmse", sql(*BASE, weights_sql(5, "inverse_rmse"), BLEND, select=f"SELECT {BLEND_METRICS}"))
def ensemble_inverse_rmse(spark, d):
    return _blend(spark, d, 5, "inverse_rmse")


@query("ensemble_uniform", sql(*BASE, weights_sql(3, "uniform"), BLEND, select=f"SELECT {BLEND_METRICS}"))
def ensemble_uniform(spark, d):
    return _blend(spark, d, 3, "uniform")


@query(
    "ensemble_diverse",
    sql(*BASE, """
        best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY val_rmse, run_name) = 1),
        weights AS (SELECT run_name, (1 / (val_rmse + 1e-10)) / sum(1 / (val_rmse + 1e-10)) OVER () AS weight FROM best)""", BLEND,
        select=f"SELECT {BLEND_METRICS}"),
)
def ensemble_diverse(spark, d):
    return _blend(spark, d, 3, "inverse_rmse", diverse=True)


@query(
    "run_names",
    """SELECT o_orderpriority || '_customer=' || CAST(o_custkey AS VARCHAR) || '_order=' || CAST(o_orderkey AS VARCHAR) AS full_name,
         CASE WHEN length('customer=' || CAST(o_custkey AS VARCHAR) || '_order=' || CAST(o_orderkey AS VARCHAR)) > 20
         THEN o_orderpriority || '_' || substr('customer=' || CAST(o_custkey AS VARCHAR) || '_order=' || CAST(o_orderkey AS VARCHAR), 1, 17) || '...'
         ELSE o_orderpriority || '_customer=' || CAST(o_custkey AS VARCHAR) || '_order=' || CAST(o_orderkey AS VARCHAR) END AS short_name FROM orders""",
)
def run_names(spark, d):
    params = F.create_map(F.lit("order"), F.col("o_orderkey").cast("string"), F.lit("customer"), F.col("o_custkey").cast("string"))
    model = F.col("o_orderpriority")
    return table(spark, d, "orders").select(
        runs.name_of_run(model, params).alias("full_name"), runs.name_of_run(model, params, 20).alias("short_name")
    )


RETAIN = [("revenue", ["purchase", "signup"], 100), ("quantity", ["view"], 50)]


@query(
    "run_retention",
    """WITH b AS (SELECT event_id, ts, CASE WHEN event_type = 'error' THEN '' ELSE upper(event_type) END AS run_name FROM events),
       t AS (SELECT *, CASE WHEN run_name = '' THEN 'unnamed' WHEN lower(run_name) IN ('purchase', 'signup') THEN 'revenue' WHEN lower(run_name) = 'view' THEN 'quantity' ELSE 'other' END AS bucket FROM b),
       a AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY ts DESC, run_name, event_id) AS age FROM t)
       SELECT bucket, count(*) AS runs, min(event_id) AS first_run, max(event_id) AS last_run FROM a
       WHERE bucket = 'unnamed' OR (bucket = 'revenue' AND age > 100) OR (bucket = 'quantity' AND age > 50) GROUP BY 1""",
)
def run_retention(spark, d):
    logged = table(spark, d, "events").select(
        "event_id", F.col("ts").alias("started"), F.when(F.col("event_type") == "error", "").otherwise(F.upper("event_type")).alias("run_name")
    )
    old = runs.runs_to_delete(logged, key="event_id", buckets=RETAIN)
    return old.groupBy("bucket").agg(F.count(F.lit(1)).alias("runs"), F.min("event_id").alias("first_run"), F.max("event_id").alias("last_run"))


@query(
    "model_comparison",
    sql(*BASE, select="""
        SELECT 'sales' AS task, model_name, round(mae, 2) AS mae, round(rmse, 2) AS rmse, round(mape, 2) AS mape,
          CAST(row_number() OVER (ORDER BY round(rmse, 2), model_name) AS INTEGER) AS place FROM (SELECT run_name AS model_name, mae, rmse, mape FROM scores WHERE split = 'test')"""),
)
def model_comparison(spark, d):
    parts = {**metrics.regression_columns(), "mape": metrics.mape()}
    tested = baseline(spark, d).where(F.col("split") == "test").groupBy(F.col("run_name").alias("model_name")).agg(
        *[parts[m].alias(m) for m in ("mae", "rmse", "mape")]
    )
    place = F.row_number().over(W.orderBy("rmse", "model_name")).cast("int")
    return runs.comparison(tested, "rmse").select(F.lit("sales").alias("task"), "*", place.alias("place"))


@query(
    "typed_run_parameters",
    """SELECT event_id, CAST(CAST(json_extract_string(props, '$.k') AS DOUBLE) AS INTEGER) AS max_depth, value AS alpha,
         [CAST(user_id AS INTEGER), CAST(user_id % 7 AS INTEGER)][2] AS second_layer FROM events""",
)
def typed_run_parameters(spark, d):
    params = F.create_map(
        F.lit("max_depth"), F.concat(F.get_json_object("props", "$.k"), F.lit(".0")), F.lit("alpha"), F.col("value").cast("string"),
        F.lit("hidden_layer_sizes"), F.format_string("(%d, %d)", F.col("user_id"), F.col("user_id") % 7),
    )
    typed = table(spark, d, "events").select("event_id", runs.typed_parameters(params).alias("p"))
    return typed.select("event_id", "p.max_depth", "p.alpha", F.get("p.hidden_layer_sizes", F.lit(1)).alias("second_layer"))


@query(
    "derived_revenue",
    sql(HOURLY, SPLIT, BASELINE, "p AS (SELECT sum(value) / count(*) AS price FROM events)",
        select=f"SELECT run_name, {R('sum(prediction * price)', 4)} AS predicted_revenue FROM base, p WHERE split = 'test' GROUP BY 1"),
)
def derived_revenue(spark, d):
    price = table(spark, d, "events").agg((F.sum("value") / F.count(F.lit(1))).alias("p")).scalar()
    revenue = runs.derived_revenue(F.col("prediction"), price)
    return baseline(spark, d).where(F.col("split") == "test").groupBy("run_name").agg(r(F.sum(revenue), 4).alias("predicted_revenue"))


# classification -----------------------------------------------------------------

QUALITY = """
q AS (SELECT labels.doc_id, quality, n_chars, CASE WHEN n_chars > 1200 THEN 1 ELSE 0 END AS guess FROM labels JOIN documents USING (doc_id))"""


def quality_guess(spark, d):
    """Labelled documents with a length rule as their predicted quality."""
    texts = table(spark, d, "documents").select("doc_id", "n_chars")
    return table(spark, d, "labels").join(texts, "doc_id").select(
        "doc_id", F.col("quality").alias("label"), "n_chars", F.when(F.col("n_chars") > 1200, 1).otherwise(0).alias("prediction")
    )


MAJORITY = """
g AS (SELECT p_brand, p_type AS guess FROM part GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) = 1),
scored AS (SELECT p_type AS label, guess AS prediction FROM part JOIN g USING (p_brand))"""
CLASS_METRICS = f"""
cells AS (SELECT label, prediction, count(*) AS n FROM scored GROUP BY 1, 2),
per AS (SELECT l.c, l.s, coalesce(p.s, 0) AS p, coalesce(h.n, 0) AS h FROM (SELECT label AS c, sum(n) AS s FROM cells GROUP BY 1) l
  LEFT JOIN (SELECT prediction AS c, sum(n) AS s FROM cells GROUP BY 1) p ON p.c = l.c LEFT JOIN cells h ON h.label = l.c AND h.prediction = l.c),
rates AS (SELECT s, h, CASE WHEN p = 0 THEN 0 ELSE h / p END AS pr, h / s AS re FROM per)"""
CLASS_SELECT = f"""
SELECT {R('sum(h) / sum(s)')} AS accuracy, {R('sum(s * pr) / sum(s)')} AS precision, {R('sum(s * re) / sum(s)')} AS recall,
  {R('sum(s * CASE WHEN pr + re = 0 THEN 0 ELSE 2 * pr * re / (pr + re) END) / sum(s)')} AS f1 FROM rates"""


def majority(spark, d):
    """Item category guessed as the most frequent one of its brand."""
    part = table(spark, d, "part")
    counted = part.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    guess = counted.groupBy("p_brand").agg(F.min_by("p_type", F.struct(-F.col("n"), "p_type")).alias("prediction"))
    return part.join(guess, "p_brand").select(F.col("p_type").alias("label"), "prediction")


@query("class_metrics", sql(MAJORITY, CLASS_METRICS, select=CLASS_SELECT))
def class_metrics(spark, d):
    return rounded(metrics.classification_metrics(majority(spark, d)))


@query("quality_metrics", sql(QUALITY, "scored AS (SELECT quality AS label, guess AS prediction FROM q)", CLASS_METRICS, select=CLASS_SELECT))
def quality_metrics(spark, d):
    return rounded(metrics.classification_metrics(quality_guess(spark, d)))


@query("confusion_pairs", sql(MAJORITY, select="SELECT label, prediction, count(*) AS rows FROM scored GROUP BY 1, 2"))
def confusion_pairs(spark, d):
    return metrics.confusion(majority(spark, d))


@query(
    "quality_confusion_matrix",
    sql(QUALITY, select="SELECT quality AS label, count(*) FILTER (guess = 0) AS \"0\", count(*) FILTER (guess = 1) AS \"1\" FROM q GROUP BY 1"),
)
def quality_confusion_matrix(spark, d):
    return metrics.confusion_matrix(quality_guess(spark, d), [0, 1])


@query(
    "quality_roc_auc",
    sql(QUALITY, select=f"""
        SELECT {R('''(SELECT sum(CASE WHEN p.n_chars > n.n_chars THEN 1.0::DOUBLE WHEN p.n_chars = n.n_chars THEN 0.5::DOUBLE ELSE 0 END) / count(*)
        FROM q p, q n WHERE p.quality = 1 AND n.quality = 0)''', 8)} AS roc_auc"""),
)
def quality_roc_auc(spark, d):
    return rounded(metrics.roc_auc(quality_guess(spark, d), F.col("label") == 1, "n_chars"), 8)


# linear models with one input have closed forms ---------------------------------

TRAIN = f"""
t AS (SELECT quantity AS x, total_price AS y, {SPLIT_CASE} AS split FROM sales),
tr AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, covar_pop(y, x) AS sxy, var_pop(x) AS sxx, stddev_pop(y) AS sy FROM t WHERE split = 'train')"""


def line_regression(spark, d):
    split = series.random_split(sales(spark, d, *SPLIT_KEYS, "quantity", "total_price"), SPLIT_KEYS)
    data = fixed_and_spread(split.select("quantity", F.col("total_price").alias("label"), "split"))
    return models.VectorAssembler(inputCols=["quantity"], outputCol="features").transform(data)


def fitted_line(spark, d, name, **params):
    data = line_regression(spark, d)
    n, std = models.label_size(data)
    model = models.regressor(name, n, std, **params).fit(data.where(F.col("split") == "train"))
    scored = models.score(model, data)
    coefficient, intercept = float(model.coefficients[0]), float(model.intercept)
    return rounded(
        metrics.regression_metrics(scored).withColumns({"slope": F.lit(coefficient), "intercept": F.lit(intercept)}), 3
    )


def line_sql(slope: str, intercept: str = "my - w * mx") -> str:
    return sql(SALES, TRAIN, f"m AS (SELECT {slope} AS w, * FROM tr)", f"f AS (SELECT w, {intercept} AS b FROM m)", select=f"""
        SELECT split, {R('sqrt(avg(power(y - w * x - b, 2)))', 3)} AS rmse, {R('avg(abs(y - w * x - b))', 3)} AS mae,
          {R('1 - sum(power(y - w * x - b, 2)) / (var_pop(y) * count(*))', 3)} AS r2, {R('min(w)', 3)} AS slope, {R('min(b)', 3)} AS intercept
        FROM t, f GROUP BY split""")


@query("linear_regression", line_sql("sxy / sxx"))
def linear_regression(spark, d):
    return fitted_line(spark, d, "LinearRegression")


@query("linear_regression_through_origin", line_sql("(sxy + mx * my) / (sxx + mx * mx)", "0.0::DOUBLE"))
def linear_regression_through_origin(spark, d):
    return fitted_line(spark, d, "LinearRegression", fit_intercept=False)


@query("ridge_regression", line_sql("sxy / (sxx + 500000.0::DOUBLE / n)"))
def ridge_regression(spark, d):
    return fitted_line(spark, d, "Ridge", alpha=500000.0)


@query("lasso_regression", line_sql("sign(sxy) * greatest(abs(sxy) - 20000, 0) / sxx"))
def lasso_regression(spark, d):
    return fitted_line(spark, d, "Lasso", alpha=20000.0)


@query("elastic_net_regression", line_sql("sign(sxy) * greatest(abs(sxy) - 20.0::DOUBLE * 0.3::DOUBLE, 0) / (sxx + 20.0::DOUBLE * 0.7::DOUBLE)"))
def elastic_net_regression(spark, d):
    return fitted_line(spark, d, "ElasticNet", alpha=20.0, l1_ratio=0.3)


# nearest neighbours --------------------------------------------------------------

NEAR_FEATURES = ["hour", "day_of_week", "prev_hour_units", "same_hour_yesterday"]


def demand_table(spark, d):
    """Hourly feature rows with label, chronological split and an hour number as key."""
    features = series.demand_features(hourly(spark, d))
    split = series.chronological_split(features, ["date", "hour"])
    key = F.datediff("date", F.lit("2000-01-01").cast("date")).cast("long") * 24 + F.col("hour")
    return cut_lineage(split.withColumns({"hour_key": key, "label": F.col("units").cast("double")}))


NEAR = """
feats AS (SELECT *, isodow(date) - 1 AS day_of_week, date_diff('day', DATE '2000-01-01', date) * 24 + hour AS hour_key FROM lags
          WHERE prev_hour_units IS NOT NULL AND same_hour_yesterday IS NOT NULL),
fp AS (SELECT *, row_number() OVER (ORDER BY date, hour) AS p, count(*) OVER () AS n FROM feats),
fs AS (SELECT *, CASE WHEN p <= floor(n * 0.7::DOUBLE) THEN 'train' WHEN p <= floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM fp)"""


def near_sql(k: int, p: int) -> str:
    gaps = [f"(a.{c} - b.{c})" for c in NEAR_FEATURES]
    distance = " + ".join(f"abs{g}" for g in gaps) if p == 1 else "sqrt(" + " + ".join(f"{g} * {g}" for g in gaps) + ")"
    return f"""
nn AS (SELECT a.hour_key, CAST({distance} AS DOUBLE) AS distance, b.units AS value, b.hour_key AS train_key FROM fs a, fs b WHERE a.split = 'test' AND b.split = 'train'
       QUALIFY row_number() OVER (PARTITION BY a.hour_key ORDER BY distance, train_key) <= {k})"""


def _knn(spark, d, **options):
    data = demand_table(spark, d)
    train, test = (data.where(F.col("split") == s) for s in ("train", "test"))
    return rounded(knn_regression(train, test, NEAR_FEATURES, "label", "hour_key", **options))


@query("knn_uniform", sql(HOURLY, LAGS, NEAR, near_sql(3, 2), select=f"SELECT hour_key, {R('avg(value)')} AS prediction FROM nn GROUP BY 1"))
def knn_uniform(spark, d):
    return _knn(spark, d, k=3)


@query(
    "knn_by_distance",
    sql(HOURLY, LAGS, NEAR, near_sql(7, 1), select=f"""
        SELECT hour_key, {R('CASE WHEN min(distance) = 0 THEN avg(CASE WHEN distance = 0 THEN value END) ELSE sum(value / nullif(distance, 0)) / sum(1 / nullif(distance, 0)) END')} AS prediction
        FROM nn GROUP BY 1"""),
)
def knn_by_distance(spark, d):
    return _knn(spark, d, k=7, weights="distance", p=1)


@query(
    "knn_classes",
    sql(HOURLY, LAGS, NEAR, near_sql(5, 2), "votes AS (SELECT hour_key, CASE WHEN value > 14 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS v, count(*) AS n FROM nn GROUP BY 1, 2)",
        select="SELECT hour_key, v AS prediction FROM votes QUALIFY row_number() OVER (PARTITION BY hour_key ORDER BY n DESC, v) = 1"),
)
def knn_classes(spark, d):
    data = demand_table(spark, d).withColumn("busy", (F.col("units") > 14).cast("double"))
    train, test = (data.where(F.col("split") == s) for s in ("train", "test"))
    return knn_classification(train, test, NEAR_FEATURES, "busy", "hour_key", 5)


# trained models without a closed form ---------------------------------------------

SMALL_GRID = {
    "LinearRegression": {"fit_intercept": [True, False]},
    "Ridge": {"alpha": [0.1, 1.0]},
    "DecisionTree": {"max_depth": [5, 10], "min_samples_leaf": [1, 4]},
    "RandomForest": {"n_estimators": [20], "max_depth": [5]},
    "BoostedTrees": {"n_estimators": [10], "max_depth": [3], "learning_rate": [0.1]},
    "KNN": {"n_neighbors": [3], "weights": ["uniform"], "p": [2]},
}


def demand_vectors(spark, d):
    data = demand_table(spark, d)
    return models.assemble(series.DEMAND_FEATURES).fit(data.where(F.col("split") == "train")).transform(data)


@query("demand_model_grid")
def demand_model_grid(spark, d):
    got, _ = models.regression_grid(demand_vectors(spark, d), SMALL_GRID, "hour_key", series.DEMAND_FEATURES)
    return got.drop("training_time")


@query("demand_model_ensemble")
def demand_model_ensemble(spark, d):
    grid = {k: SMALL_GRID[k] for k in ("LinearRegression", "DecisionTree", "RandomForest")}
    table_, scored = models.regression_grid(demand_vectors(spark, d), grid, "hour_key", series.DEMAND_FEATURES)
    columns = {row["run_name"]: f"p{i}" for i, row in enumerate(table_.select("run_name").collect())}
    chosen = runs.ensemble_weights(runs.top_runs(table_, 3), "inverse_rmse", 1e-10)
    weights = {columns[w["run_name"]]: w["weight"] for w in chosen.collect()}
    return metrics.regression_metrics(runs.blended(scored, weights))


#: Lines that are kept as whole rows; of more only their assembled columns are stored.
FEW_LINES = 1 << 20


def revenue_data(spark, d, assembler):
    """Assembled feature table fixed in storage: fitting the selector, the model and the metrics each read it.

    Of many lines the vectors themselves are stored, as to assemble them takes longer than to read them.
    """
    features = models.revenue_features(sales(spark, d))
    if table(spark, d, "lineitem").count() <= FEW_LINES:
        return assembler.transform(fixed_and_spread(features))
    return stored(assembler.transform(features).select(assembler.getOutputCol(), "label", "split"))


@query("revenue_boosted_trees")
def revenue_boosted_trees(spark, d):
    """Of many lines the trees learn from the cells that their bins make: each pass over them is one over far fewer rows."""
    assembler, *rest = models.assemble(models.REVENUE_NUMERIC).getStages()
    data = revenue_data(spark, d, assembler)
    boosted = models.regressor("BoostedTrees", n_estimators=10, max_depth=5, learning_rate=0.2)
    train = F.col("split") == "train"
    if data.columns == ["all_features", "label", "split"]:
        of = "all_features", len(models.REVENUE_NUMERIC)
        data = models.binned(data, *of, models.tree_borders(data.where(train), *of))
        cells = models.cells_of(data.where(train), "all_features")
        chosen = models.Pipeline(stages=rest).fit(cells)
        fitted, assembled = boosted.setWeightCol("rows").fit(chosen.transform(cells)), chosen.transform(data)
    else:
        assembled = models.Pipeline(stages=rest).fit(data.where(train)).transform(data)
        fitted = boosted.fit(assembled.where(train))
    return metrics.regression_metrics(models.score(fitted, assembled))


def class_data(spark, d):
    """Item category from price and size, stratified into train and test."""
    part = table(spark, d, "part")
    brand = F.substring_index("p_brand", "#", -1).cast("double")
    data = part.select("p_partkey", "p_type", "p_retailprice", F.col("p_size").cast("double").alias("size"), brand.alias("brand"))
    indexed = models.StringIndexer(inputCol="p_type", outputCol="label", stringOrderType="alphabetAsc").fit(data).transform(data)
    return cut_lineage(
        models.VectorAssembler(inputCols=["p_retailprice", "size", "brand"], outputCol="features").transform(
            series.stratified_split(indexed, "p_type", ["p_partkey"])
        )
    )


@query("classifier_comparison")
def classifier_comparison(spark, d):
    data = class_data(spark, d)
    train, test = (data.where(F.col("split") == s) for s in ("train", "test"))
    rows = None
    for name in ("LogisticRegression", "NaiveBayes", "DecisionTree", "RandomForest"):
        model = models.classifier(name, classes=6, width=3, trees=20, depth=5).fit(train)
        one = metrics.classification_metrics(models.score(model, test)).select(F.lit(name).alias("model_name"), "*")
        rows = one if rows is None else rows.unionByName(one)
    return runs.comparison(rows, "f1", ascending=False, digits=4)


@query("boosted_and_neural_classifiers")
def boosted_and_neural_classifiers(spark, d):
    """Item category, six classes; boosted trees one class against the rest."""
    data = class_data(spark, d)
    train, test = (data.where(F.col("split") == s) for s in ("train", "test"))
    parts = []
    for name in ("BoostedTrees", "NeuralNetwork"):
        model = models.classifier(name, classes=6, width=3, trees=5, depth=3).fit(train)
        parts.append(metrics.classification_metrics(models.score(model, test)).select(F.lit(name).alias("model_name"), "*"))
    return parts[0].unionByName(parts[1])


@query("champion_refit_and_reload")
def champion_refit_and_reload(spark, d):
    """Refit a chosen model on train and validation rows, save it, load it again and check the copy on the test rows."""
    data = demand_table(spark, d)
    stages = [*models.assemble(series.DEMAND_FEATURES).getStages(), models.regressor("LinearRegression")]
    fitted = models.refit(models.Pipeline(stages=stages), data)
    test = data.where(F.col("split") == "test")
    copy, sample = models.save_and_reload(fitted, scratch_path(spark, "model"), test)
    same = sample.join(models.score(fitted, test).select("hour_key", F.col("prediction").alias("before")), "hour_key")
    checked = same.agg(F.max(F.abs(F.col("prediction") - F.col("before"))).alias("m")).scalar()
    return metrics.regression_metrics(models.score(copy, test)).withColumn("reload_gap", checked)


@query("forecaster_comparison")
def forecaster_comparison(spark, d):
    data = demand_table(spark, d).withColumn("split", F.when(F.col("split") == "train", "train").otherwise("test"))
    few = {k: compare.FORECASTERS[k] for k in ("Linear Regression", "Ridge Regression", "Lasso Regression", "KNN Regression", "Decision Tree")}
    return compare.compare_forecasters(data, series.DEMAND_FEATURES, "hour_key", ["hour_key"], window=7, forecasters=few)


@query("promotion_classifier_comparison")
def promotion_classifier_comparison(spark, d):
    """Promoted items told from the rest by price, size and brand, by all classifiers of the comparison."""
    data = class_data(spark, d).drop("features").withColumn("label", (F.col("p_type") == "PROMO").cast("double"))
    return compare.compare_classifiers(data, ["p_retailprice", "size", "brand"], "p_partkey")


@query("clustering_comparison")
def clustering_comparison(spark, d):
    part = table(spark, d, "part")
    data = part.select("p_partkey", "p_retailprice", F.col("p_size").cast("double").alias("size"))
    return compare.compare_clusterings(data, "p_partkey", ["p_retailprice", "size"], k=3, eps=0.2, min_samples=4)
