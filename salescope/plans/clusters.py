"""Scaling, clustering and cluster quality queries over products and items."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescope.functions.items import add_label_code, ingredient_count
from salescope.learn.runs import cluster_champion
from salescope.operators import clusters
from salescope.operators.density import dbscan
from salescope.operators.ordered import number_rows
from salescope.plans.registry import IDENTITY, PRODUCTS, R, SALES, query, r, rounded, sql
from salescope.plans.totals import identity, item_base, products
from salescope.session import cut_lineage
from salescope.sources.views import item_sales, table

FEATURES = ["unit_price", "ingredient_count", "size_code", "category_code"]


def product_points(spark, d):
    """Numbered products (by name) with their four features, unscaled."""
    described = identity(item_sales(spark, d, "item_name", "item_size", "category", "ingredients"))
    named = cut_lineage(described.withColumn("ingredient_count", ingredient_count(F.col("ingredients")).cast("double")))
    for column, code in (("item_size", "size_code"), ("category", "category_code")):
        named = add_label_code(named, column, code)
    return number_rows(named.select("item_name", *FEATURES), [F.col("item_name")], "id")


def scaled_products(spark, d):
    return cut_lineage(clusters.standardise(product_points(spark, d), FEATURES))


POINTS = """
points AS (
  SELECT CAST(dense_rank() OVER (ORDER BY item_name) - 1 AS INTEGER) AS id, item_name, unit_price,
         CAST(len(string_split(ingredients, ',')) AS DOUBLE) AS ingredient_count,
         CAST(dense_rank() OVER (ORDER BY item_size) - 1 AS DOUBLE) AS size_code,
         CAST(dense_rank() OVER (ORDER BY category) - 1 AS DOUBLE) AS category_code FROM identity)"""


def scale_sql(columns: list[str], source: str = "points", keep: str = "id, item_name") -> str:
    scaled = ", ".join(
        f"({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END AS {c}" for c in columns
    )
    return f"z AS (SELECT {keep}, {scaled} FROM {source})"


def distance_sql(columns: list[str], metric: str) -> str:
    if metric == "manhattan":
        return " + ".join(f"abs(a.{c} - b.{c})" for c in columns)
    return "sqrt(" + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in columns) + ")"


def dbscan_sql(columns: list[str], eps: float, min_samples: int, metric: str) -> str:
    return f"""
near AS (SELECT a.id AS i, b.id AS j FROM z a, z b WHERE {distance_sql(columns, metric)} <= {eps}::DOUBLE),
core AS (SELECT i FROM near GROUP BY i HAVING count(*) >= {min_samples}),
link AS (SELECT i, j FROM near WHERE i IN (SELECT i FROM core) AND j IN (SELECT i FROM core)),
reach(i, root) AS (SELECT i, i FROM core UNION SELECT link.j, reach.root FROM reach JOIN link ON link.i = reach.i),
comp AS (SELECT i, min(root) AS root FROM reach GROUP BY i),
num AS (SELECT i, dense_rank() OVER (ORDER BY root) - 1 AS label FROM comp),
labelled AS (
  SELECT z.*, CAST(coalesce((SELECT min(num.label) FROM num WHERE num.i = z.id),
    (SELECT min(num.label) FROM near JOIN num ON num.i = near.j WHERE near.i = z.id), -1) AS INTEGER) AS cluster FROM z)"""


@query(
    "scaled_products",
    sql(SALES, IDENTITY, POINTS, scale_sql(FEATURES), select="SELECT item_name, " + ", ".join(f"{R(c, 8)} AS {c}" for c in FEATURES) + " FROM z"),
)
def scaled_products_query(spark, d):
    return rounded(scaled_products(spark, d).drop("id"), 8)


def labelled_products(spark, d, eps=0.5, min_samples=2, metric="euclidean"):
    points = scaled_products(spark, d)
    return points.join(dbscan(points, "id", FEATURES, eps, min_samples, metric), "id")


@query(
    "dbscan_products",
    sql(SALES, IDENTITY, POINTS, scale_sql(FEATURES), dbscan_sql(FEATURES, 0.5, 2, "euclidean"), recursive=True,
        select="SELECT item_name, cluster FROM labelled"),
)
def dbscan_products(spark, d):
    return labelled_products(spark, d).select("item_name", "cluster")


@query(
    "dbscan_products_manhattan",
    sql(SALES, IDENTITY, POINTS, scale_sql(FEATURES), dbscan_sql(FEATURES, 1.0, 4, "manhattan"), recursive=True,
        select="SELECT item_name, cluster FROM labelled"),
)
def dbscan_products_manhattan(spark, d):
    return labelled_products(spark, d, 1.0, 4, "manhattan").select("item_name", "cluster")


PART_FEATURES = ["price", "size", "kind"]
PART_POINTS = """
points AS (SELECT p_partkey AS id, p_retailprice AS price, CAST(p_size AS DOUBLE) AS size,
           CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS DOUBLE) AS kind, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS cluster FROM part)"""


def part_points(spark, d):
    coded = add_label_code(table(spark, d, "part"), "p_type", "code")
    raw = coded.select(
        F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("price"), F.col("p_size").cast("double").alias("size"),
        F.col("code").cast("double").alias("kind"), F.col("code").cast("int").alias("cluster"),
    )
    return cut_lineage(clusters.standardise(raw, PART_FEATURES))


@query(
    "dbscan_items",
    sql(PART_POINTS, scale_sql(PART_FEATURES, keep="id"), dbscan_sql(PART_FEATURES, 0.1, 3, "euclidean"), recursive=True,
        select="SELECT id AS item_id, cluster FROM labelled"),
)
def dbscan_items(spark, d):
    points = part_points(spark, d)
    return dbscan(points, "id", PART_FEATURES, 0.1, 3).withColumnRenamed("id", "item_id")


@query(
    "cluster_counts",
    sql(SALES, IDENTITY, POINTS, scale_sql(FEATURES), dbscan_sql(FEATURES, 0.5, 2, "euclidean"), recursive=True,
        select="SELECT count(DISTINCT CASE WHEN cluster <> -1 THEN cluster END) AS clusters, count(*) FILTER (cluster = -1) AS noise FROM labelled"),
)
def cluster_counts(spark, d):
    return clusters.cluster_counts(labelled_products(spark, d))


def silhouette_sql(columns: list[str]) -> str:
    return f"""
each AS (SELECT a.id, a.cluster, b.cluster AS other, sum({distance_sql(columns, 'euclidean')}) AS total, count(*) AS n
         FROM w a, w b GROUP BY 1, 2, 3),
width AS (SELECT id, max(CASE WHEN cluster = other AND n > 1 THEN total / (n - 1) END) AS a, min(CASE WHEN cluster <> other THEN total / n END) AS b FROM each GROUP BY 1)"""


@query(
    "item_silhouette",
    sql(PART_POINTS, scale_sql(PART_FEATURES, keep="id, cluster"), "w AS (SELECT * FROM z WHERE cluster <> -1)", silhouette_sql(PART_FEATURES),
        select=f"SELECT {R('avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END)', 8)} AS silhouette FROM width"),
)
def item_silhouette(spark, d):
    return rounded(clusters.silhouette(part_points(spark, d), "id", PART_FEATURES), 8)


@query(
    "product_silhouette",
    sql(SALES, IDENTITY, POINTS, scale_sql(FEATURES), dbscan_sql(FEATURES, 0.5, 2, "euclidean"), "w AS (SELECT * FROM labelled WHERE cluster <> -1)",
        silhouette_sql(FEATURES), recursive=True,
        select=f"SELECT {R('avg(CASE WHEN a IS NULL THEN 0 ELSE coalesce((b - a) / greatest(a, b), 0) END)', 8)} AS silhouette FROM width"),
)
def product_silhouette(spark, d):
    return rounded(clusters.silhouette(cut_lineage(labelled_products(spark, d)), "id", FEATURES), 8)


def squared_silhouette_sql(columns: list[str]) -> str:
    """All squared distances, averaged by cluster."""
    gap = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in columns)
    return f"""
each AS (SELECT a.id, a.cluster, b.cluster AS other, sum({gap}) AS total, count(*) AS n FROM w a, w b GROUP BY 1, 2, 3),
width AS (SELECT id, max(CASE WHEN cluster = other AND n > 1 THEN total / (n - 1) END) AS a, min(CASE WHEN cluster <> other THEN total / n END) AS b FROM each GROUP BY 1)"""


@query(
    "item_silhouette_squared",
    sql(PART_POINTS, scale_sql(PART_FEATURES, keep="id, cluster"), "w AS (SELECT * FROM z WHERE cluster <> -1)", squared_silhouette_sql(PART_FEATURES),
        select=f"SELECT {R('avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END)', 8)} AS silhouette FROM width"),
)
def item_silhouette_squared(spark, d):
    return rounded(clusters.silhouette_squared(part_points(spark, d), PART_FEATURES), 8)


@query(
    "product_silhouette_squared",
    sql(SALES, IDENTITY, POINTS, scale_sql(FEATURES), dbscan_sql(FEATURES, 0.5, 2, "euclidean"), "w AS (SELECT * FROM labelled WHERE cluster <> -1)",
        squared_silhouette_sql(FEATURES), recursive=True,
        select=f"SELECT {R('avg(CASE WHEN a IS NULL THEN 0 ELSE coalesce((b - a) / greatest(a, b), 0) END)', 8)} AS silhouette FROM width"),
)
def product_silhouette_squared(spark, d):
    return rounded(clusters.silhouette_squared(cut_lineage(labelled_products(spark, d)), FEATURES), 8)


def centroid_sql(columns: list[str]) -> str:
    means = ", ".join(f"avg({c}) AS m_{c}" for c in columns)
    gap = " + ".join(f"(w.{c} - m.m_{c}) * (w.{c} - m.m_{c})" for c in columns)
    return f"""
w AS (SELECT * FROM z WHERE cluster <> -1),
m AS (SELECT cluster, {means}, count(*) AS n FROM w GROUP BY 1),
s AS (SELECT m.cluster, avg(sqrt({gap})) AS scatter, sum({gap}) AS within FROM w JOIN m USING (cluster) GROUP BY 1)"""


def _between(columns, a, b):
    return " + ".join(f"({a}.m_{c} - {b}.m_{c}) * ({a}.m_{c} - {b}.m_{c})" for c in columns)


@query(
    "item_davies_bouldin",
    sql(PART_POINTS, scale_sql(PART_FEATURES, keep="id, cluster"), centroid_sql(PART_FEATURES), f"""
        worst AS (SELECT a.cluster, max((sa.scatter + sb.scatter) / sqrt({_between(PART_FEATURES, 'a', 'b')})) AS ratio
                  FROM m a JOIN m b ON a.cluster <> b.cluster JOIN s sa ON sa.cluster = a.cluster JOIN s sb ON sb.cluster = b.cluster GROUP BY 1)""",
        select=f"SELECT {R('avg(ratio)', 8)} AS davies_bouldin FROM worst"),
)
def item_davies_bouldin(spark, d):
    return rounded(clusters.davies_bouldin(part_points(spark, d), PART_FEATURES), 8)


@query(
    "item_calinski_harabasz",
    sql(PART_POINTS, scale_sql(PART_FEATURES, keep="id, cluster"), centroid_sql(PART_FEATURES),
        "g AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in PART_FEATURES) + ", count(*) AS n FROM w)",
        select=f"""SELECT {R(f"(SELECT sum(m.n * ({_between(PART_FEATURES, 'm', 'g')})) FROM m, g) * ((SELECT n FROM g) - count(*)) / (sum(within) * (count(*) - 1))", 6)}
        AS calinski_harabasz FROM s"""),
)
def item_calinski_harabasz(spark, d):
    return rounded(clusters.calinski_harabasz(part_points(spark, d), PART_FEATURES), 6)


@query("kmeans_products")
def kmeans_products(spark, d):
    points = scaled_products(spark, d)
    labels = clusters.kmeans(points, "id", FEATURES, 5, n_init=3)
    return points.join(labels, "id").select("item_name", "cluster")


@query("hierarchical_items")
def hierarchical_items(spark, d):
    points = part_points(spark, d).drop("cluster")
    labels = clusters.divisive(points, "id", PART_FEATURES, 5)
    return points.join(labels, "id").groupBy("cluster").agg(F.count(F.lit(1)).alias("items"), r(F.avg("price"), 6).alias("price"))


@query("mixture_items")
def mixture_items(spark, d):
    points = part_points(spark, d).drop("cluster")
    labels = clusters.mixture(points, "id", PART_FEATURES, 3)
    return points.join(labels, "id").groupBy("cluster").agg(F.count(F.lit(1)).alias("items"), r(F.avg("size"), 6).alias("size"))


@query("cluster_grid")
def cluster_grid(spark, d):
    """All 32 configurations over the products."""
    return clusters.cluster_grid(scaled_products(spark, d), "id", FEATURES)


@query("cluster_champion")
def cluster_champion_query(spark, d):
    """The best of all 32 configurations over the items."""
    return cluster_champion(clusters.cluster_grid(part_points(spark, d), "id", PART_FEATURES)).drop("seconds")


SIZE_CUTS = """
v AS (SELECT CAST(p_size AS DOUBLE) AS x, count(*) AS n FROM part GROUP BY 1),
c AS (SELECT x, sum(n) OVER o AS n, sum(n * x) OVER o AS s, sum(n * x * x) OVER o AS q FROM v WINDOW o AS (ORDER BY x)),
w AS (SELECT max(n) AS n, max(s) AS s, max(q) AS q FROM c),
cuts AS (SELECT a.x AS a, b.x AS b, a.n AS n1, b.n - a.n AS n2, w.n - b.n AS n3, a.s AS s1, b.s - a.s AS s2, w.s - b.s AS s3,
           w.q - a.s * a.s / a.n - (b.s - a.s) * (b.s - a.s) / (b.n - a.n) - (w.s - b.s) * (w.s - b.s) / (w.n - b.n) AS inertia
         FROM c a JOIN c b ON a.x < b.x CROSS JOIN w WHERE b.n < w.n),
best AS (SELECT * FROM cuts ORDER BY inertia, a, b LIMIT 1)"""


@query(
    "kmeans_sizes",
    sql(SIZE_CUTS, select=f"""
        SELECT unnest([0, 1, 2]) AS cluster, CAST(unnest([n1, n2, n3]) AS BIGINT) AS items, round(unnest([s1 / n1, s2 / n2, s3 / n3]), 6) AS middle,
          {R('inertia', 4)} AS inertia FROM best"""),
)
def kmeans_sizes(spark, d):
    """Three clusters of item sizes, the best of 20 seeds, next to the best of all ways to cut the sizes twice."""
    sizes = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("size"))
    labelled = cut_lineage(sizes.join(clusters.kmeans(sizes, "p_partkey", ["size"], 3, n_init=20), "p_partkey"))
    middle = labelled.groupBy("cluster").agg(F.count(F.lit(1)).alias("items"), F.avg("size").alias("middle"), (F.var_pop("size") * F.count(F.lit(1))).alias("within"))
    whole = middle.agg(F.sum("within")).scalar()
    return middle.select("cluster", "items", r("middle").alias("middle"), r(whole, 4).alias("inertia"))


@query(
    "mixture_of_one",
    sql(PART_POINTS, scale_sql(PART_FEATURES, keep="id"), select="SELECT " + ", ".join(
        [f"{R(f'avg({c})')} AS mean_{c}" for c in PART_FEATURES]
        + [f"{R(f'covar_pop({a}, {b}) + ' + ('0.000001' if a == b else '0.0'), 5)} AS cov_{a}_{b}" for i, a in enumerate(PART_FEATURES) for b in PART_FEATURES[i:]]
        + [f"{R('0.0')} AS tied_gap"]) + " FROM z"),
)
def mixture_of_one(spark, d):
    """A mixture of one component has the mean and covariance of the rows, tied or not."""
    data = clusters.points(part_points(spark, d), "id", PART_FEATURES)
    (full, _), (tied, _) = clusters.mixtures(data, PART_FEATURES, [clusters.Shape(1, False, "random"), clusters.Shape(1, True, "kmeans")])
    n = len(PART_FEATURES)
    row = [float(m) for m in full.means[0]] + [float(full.covariances[0][i][j]) for i in range(n) for j in range(i, n)]
    names = [f"mean_{c}" for c in PART_FEATURES] + [f"cov_{a}_{b}" for i, a in enumerate(PART_FEATURES) for b in PART_FEATURES[i:]]
    gap = float(abs(full.covariances - tied.covariances).max() + abs(full.means - tied.means).max())
    made = spark.createDataFrame([(*row, gap)], ", ".join(f"{c} double" for c in [*names, "tied_gap"]))
    return made.select(*[r(F.col(c) + 0.0, 5 if c.startswith("cov") else 6).alias(c) for c in [*names, "tied_gap"]])


@query("cluster_bundles")
def cluster_bundles(spark, d):
    points = scaled_products(spark, d)
    labels = points.select("id", "item_name").join(
        clusters.kmeans(points, "id", ["unit_price", "ingredient_count", "size_code"], 5), "id"
    )
    return clusters.cluster_bundles(products(item_sales(spark, d, "item_name")), labels.select("item_name", "cluster"))


@query(
    "category_bundles",
    sql(SALES, PRODUCTS, IDENTITY, """
        t AS (SELECT i.item_name, CAST(dense_rank() OVER (ORDER BY i.category) - 1 AS INTEGER) AS cluster, lines, unit_price_sum FROM identity i JOIN products USING (item_name)),
        g AS (SELECT cluster, count(*) AS items, CAST(sum(lines) AS BIGINT) AS popularity, sum(unit_price_sum) / sum(lines) AS price FROM t GROUP BY 1)""",
        select="""
        SELECT cluster, CASE WHEN price < 12 THEN 'Budget Friendly' WHEN price < 16 THEN 'Popular Favorites' WHEN price < 20 THEN 'Premium Selection'
          ELSE 'Gourmet Collection' END AS bundle_type,
          (SELECT string_agg(item_name, ',' ORDER BY item_name) FROM (SELECT item_name FROM t WHERE t.cluster = g.cluster ORDER BY 1 LIMIT 5)) AS members,
          round(price, 2) AS avg_price, popularity, 'Offer ' || least(items, 3) || ' of its items together' AS recommendation
        FROM g WHERE items >= 2"""),
)
def category_bundles(spark, d):
    base = item_base(spark, d)
    kinds = cut_lineage(identity(base).select("item_name", "category"))
    labels = cut_lineage(add_label_code(kinds, "category", "cluster").select("item_name", "cluster"))
    got = clusters.cluster_bundles(products(base), labels)
    return got.withColumn("members", F.array_join("members", ","))
