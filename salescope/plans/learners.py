"""Trained models next to closed forms: trees of depth one, boosting rounds, Gaussian Bayes, a logistic model of one flag, AUC by class."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from salescope.learn import metrics, models
from salescope.operators import series
from salescope.plans.profiles import SPLIT_CASE, SPLIT_KEYS
from salescope.plans.registry import SALES, R, query, r, row_spread_sql, rounded, sql
from salescope.session import cut_lineage, fixed_and_spread
from salescope.sources.views import sales, table

STEP = 0.1


def stump_sql(name: str, label: str, source: str) -> list[str]:
    """The best cut of two inputs with few values: least squared error, then first input and value."""
    return [
        f"""{name}_v AS (SELECT 1 AS f, x1 AS x, count(*) AS n, sum({label}) AS s, sum({label} * {label}) AS q FROM {source} WHERE split = 'train' GROUP BY 2
              UNION ALL SELECT 2, x2, count(*), sum({label}), sum({label} * {label}) FROM {source} WHERE split = 'train' GROUP BY 2)""",
        f"""{name}_c AS (SELECT f, x, sum(n) OVER o AS n, sum(s) OVER o AS s, sum(n) OVER w AS nn, sum(s) OVER w AS ss, lead(x) OVER (PARTITION BY f ORDER BY x) AS up
              FROM {name}_v WINDOW o AS (PARTITION BY f ORDER BY x), w AS (PARTITION BY f))""",
        f"""{name} AS (SELECT f, (x + up) / 2.0::DOUBLE AS cut, s / n AS low, (ss - s) / (nn - n) AS high FROM {name}_c WHERE up IS NOT NULL
              ORDER BY s * s / n + (ss - s) * (ss - s) / (nn - n) DESC, f, x LIMIT 1)""",
    ]


def _leaf(name: str) -> str:
    return f"(SELECT CASE WHEN CASE WHEN f = 1 THEN x1 ELSE x2 END <= cut THEN low ELSE high END FROM {name})"


@query(
    "models_of_depth_one",
    sql(SALES, f"t AS (SELECT CAST(hour AS DOUBLE) AS x1, CAST(isodow(order_date) AS DOUBLE) AS x2, total_price AS y, {SPLIT_CASE} AS split FROM sales)",
        *stump_sql("one", "y", "t"),
        f"t1 AS (SELECT *, {_leaf('one')} AS p1, 2 * (y - {_leaf('one')}) AS rest FROM t)", *stump_sql("two", "rest", "t1"),
        f"t2 AS (SELECT *, p1 + {STEP}::DOUBLE * {_leaf('two')} AS p2 FROM t1)",
        select=f"""SELECT model_name, split, {R('sqrt(avg(power(y - p, 2)))', 4)} AS rmse, {R('avg(abs(y - p))', 4)} AS mae,
          {R('1 - sum(power(y - p, 2)) / (var_pop(y) * count(*))', 6)} AS r2 FROM (
            SELECT split, y, unnest(['DecisionTree', 'RandomForest', 'BoostedTrees_1', 'BoostedTrees_2']) AS model_name, unnest([p1, p1, p1, p2]) AS p FROM t2) GROUP BY 1, 2"""),
)
def models_of_depth_one(spark, d):
    """Line revenue by hour and weekday: a tree of one cut, a forest of one such tree, and one and two boosting rounds."""
    split = series.random_split(sales(spark, d, *SPLIT_KEYS, "order_time", "order_date", "total_price"), SPLIT_KEYS)
    rows = split.select(F.substring("order_time", 1, 2).cast("double").alias("hour"), (F.weekday("order_date") + 1).cast("double").alias("day"),
                        F.col("total_price").alias("label"), "split")
    return depth_one_metrics(fixed_and_spread(rows))


def depth_one_metrics(rows):
    """Fitted on one weighted row for each hour, weekday and split, which have at most 24 x 7 x 3, and measured on all ``rows`` in one pass.

    All rows of a cell fall on the same side of every cut, so their mean label with their number gives the same cuts and leaves.
    """
    known = F.when(F.count("label") == F.count(F.lit(1)), F.avg("label"))  # a label that is missing is refused by the models
    cells = cut_lineage(rows.groupBy("hour", "day", "split").agg(known.alias("label"), F.count(F.lit(1)).cast("double").alias("rows")))
    data = VectorAssembler(inputCols=["hour", "day"], outputCol="features").transform(cells)
    train = data.where(F.col("split") == "train")
    made = {
        "DecisionTree": DecisionTreeRegressor(maxDepth=1),
        "RandomForest": RandomForestRegressor(maxDepth=1, numTrees=1, featureSubsetStrategy="all", bootstrap=False),
        "BoostedTrees_1": GBTRegressor(maxDepth=1, maxIter=1, stepSize=STEP),
        "BoostedTrees_2": GBTRegressor(maxDepth=1, maxIter=2, stepSize=STEP),
    }
    for name, model in made.items():
        data = model.setWeightCol("rows").fit(train).setPredictionCol(name).transform(data)
    scored = rows.join(F.broadcast(data.select("hour", "day", "split", *made)), ["hour", "day", "split"])
    wide = scored.groupBy("split").agg(*[
        F.struct(*[c.alias(m) for m, c in metrics.regression_columns(prediction=name).items()]).alias(name) for name in made])
    whole = wide.select("split", F.inline(F.array(*[F.struct(F.lit(name).alias("model_name"), f"{name}.*") for name in made])))
    return whole.select("model_name", "split", r("rmse", 4).alias("rmse"), r("mae", 4).alias("mae"), r("r2", 6).alias("r2"))


KINDS = f"""
h AS (SELECT p_partkey, p_type, p_retailprice AS x1, CAST(p_size AS DOUBLE) AS x2, {row_spread_sql('p_partkey')} AS h FROM part),
c AS (SELECT p_type, count(*) AS n, floor(count(*) * 0.2::DOUBLE) AS low, round(count(*) * 0.2::DOUBLE - floor(count(*) * 0.2::DOUBLE), 9) AS rest FROM h GROUP BY 1),
a AS (SELECT p_type, low + CASE WHEN row_number() OVER (ORDER BY rest DESC, n DESC, p_type) <= (SELECT ceil(sum(n) * 0.2::DOUBLE) - sum(low) FROM c) THEN 1 ELSE 0 END AS take FROM c),
k AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY p_type ORDER BY h, p_partkey) <= take THEN 'test' ELSE 'train' END AS split FROM h JOIN a USING (p_type))"""


@query(
    "gaussian_bayes_classes",
    sql(KINDS, """m AS (SELECT p_type AS guess, ln(count(*)) AS prior, avg(x1) AS m1, avg(x2) AS m2, var_pop(x1) AS v1, var_pop(x2) AS v2 FROM k WHERE split = 'train' GROUP BY 1)""",
        """g AS (SELECT p_partkey, p_type, guess, prior - 0.5 * (ln(v1) + power(x1 - m1, 2) / v1 + ln(v2) + power(x2 - m2, 2) / v2) AS s FROM k, m WHERE split = 'test')""",
        "b AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY s DESC, guess) = 1)",
        select="SELECT p_type AS actual, guess AS predicted, count(*) AS items FROM b GROUP BY 1, 2"),
)
def gaussian_bayes_classes(spark, d):
    """Item category, six classes, by price and size: the confusion of the test rows."""
    part = table(spark, d, "part").select("p_partkey", "p_type", "p_retailprice", F.col("p_size").cast("double").alias("size"))
    split = series.stratified_split(part, "p_type", ["p_partkey"])
    train = split.where(F.col("split") == "train")
    indexer = models.StringIndexer(inputCol="p_type", outputCol="label", stringOrderType="alphabetAsc").fit(train)
    data = cut_lineage(VectorAssembler(inputCols=["p_retailprice", "size"], outputCol="features").transform(indexer.transform(split)))
    model = models.classifier("NaiveBayes").fit(data.where(F.col("split") == "train"))
    scored = model.transform(data.where(F.col("split") == "test"))
    names = F.array(*[F.lit(name) for name in indexer.labels])
    return scored.groupBy(F.col("p_type").alias("actual"), F.get(names, F.col("prediction").cast("int")).alias("predicted")).agg(F.count(F.lit(1)).alias("items"))


@query(
    "logistic_of_a_flag",
    """WITH t AS (SELECT CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS flag, CASE WHEN p_type IN ('PROMO', 'ECONOMY') THEN 1 ELSE 0 END AS y FROM part),
         s AS (SELECT flag, avg(y) AS p FROM t GROUP BY 1), l AS (SELECT flag, ln(p / (1 - p)) AS z, p FROM s)
       SELECT round(max(CASE WHEN flag = 0 THEN z END), 3) AS intercept, round(max(CASE WHEN flag = 1 THEN z END) - max(CASE WHEN flag = 0 THEN z END), 3) AS weight FROM l""",
)
def logistic_of_a_flag(spark, d):
    """A logistic model of one 0/1 input has the log odds of both groups."""
    flag = (F.col("p_size") > 25).cast("double").alias("flag")
    data = table(spark, d, "part").select(flag, F.col("p_type").isin("PROMO", "ECONOMY").cast("double").alias("label"))
    model = LogisticRegression(maxIter=1000, tol=1e-12).fit(VectorAssembler(inputCols=["flag"], outputCol="features").transform(data))
    return rounded(spark.createDataFrame([(float(model.intercept), float(model.coefficients[0]))], "intercept double, weight double"), 3)


SCORES = {"ECONOMY": "p_retailprice", "PROMO": "p_size", "STANDARD": "p_size % 7"}


@query(
    "auc_by_class",
    sql("t AS (SELECT p_type, p_retailprice, CAST(p_size AS DOUBLE) AS p_size FROM part)",
        "one AS (" + " UNION ALL ".join(f"SELECT '{c}' AS class, p_type = '{c}' AS hit, CAST({e} AS DOUBLE) AS s FROM t" for c, e in SCORES.items()) + ")",
        """ranked AS (SELECT class, hit, rank() OVER (PARTITION BY class ORDER BY s) + (count(*) OVER (PARTITION BY class, s) - 1) / 2.0::DOUBLE AS place FROM one)""",
        """auc AS (SELECT class, (sum(place) FILTER (hit) - count(*) FILTER (hit) * (count(*) FILTER (hit) + 1) / 2.0::DOUBLE)
              / (count(*) FILTER (hit) * count(*) FILTER (NOT hit)) AS auc, count(*) FILTER (hit) AS rows FROM ranked GROUP BY 1)""",
        select=f"SELECT class, {R('auc', 8)} AS roc_auc, rows FROM auc UNION ALL SELECT 'mean', {R('avg(auc)', 8)}, CAST(sum(rows) AS BIGINT) FROM auc"),
)
def auc_by_class(spark, d):
    """One class against the rest, each with a score of its own, and the mean over classes."""
    part = table(spark, d, "part").withColumn("p_size", F.col("p_size").cast("double"))
    scored = part.select("p_type", *[F.expr(e).cast("double").alias(f"s_{c}") for c, e in SCORES.items()])
    return rounded(metrics.class_auc(scored, "p_type", {c: f"s_{c}" for c in SCORES}), 8)
