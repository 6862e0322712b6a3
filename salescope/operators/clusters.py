"""Scaling, centroid and mixture clustering, cluster quality and the clustering grid."""

from __future__ import annotations

import itertools
import math
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from salescope.operators.centroids import Shape, Start, best_start, kmeans_starts, likeliest, mixtures, nearest_centre, points
from salescope.operators.density import dbscan
from salescope.operators.linkage import hierarchies
from salescope.operators.ordered import number_rows, one_row
from salescope.operators.tiles import TILE_ROWS, tiled, tiled_self
from salescope.session import cut_lineage, unsent

NO_SCORE = -1.0


def standardise(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Columns minus their mean over the population deviation; a constant column is only centred.

    ``fit_on`` takes mean and deviation from other rows, such as the train split. Two numbers per column
    are fetched, from one pass.
    """
    source = df if fit_on is None else fit_on
    stats = source.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return df.withColumns({c: (F.col(c) - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"] or 1.0) for c in columns})


def vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


def _predict(model, data: DataFrame, key: str) -> DataFrame:
    return model.transform(data).select(key, F.col("prediction").alias("cluster"))


def kmeans(df: DataFrame, key: str, features: Sequence[str], k: int, init: str = "k-means++", n_init: int = 1,
           seed: int = 42) -> DataFrame:
    """Labels of the lowest-cost model among ``n_init`` seeds, all fitted in the same passes."""
    data = points(df, key, features)
    starts = [Start(k, init, seed + i) for i in range(n_init)]
    return nearest_centre(data, key, features, best_start(kmeans_starts(data, features, starts), range(n_init)))


def divisive(df: DataFrame, key: str, features: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """Hierarchical labels by repeated bisection.

    Spark starts a split by nudging the centre in proportion to its length, which does nothing to centred
    data; the points are moved away from the origin first, and moving all points changes no cluster.
    """
    ends = one_row(df.agg(*[f(c).alias(f"{n}_{c}") for c in features for n, f in (("lo", F.min), ("hi", F.max))]))
    moved = df.select(key, *[(F.col(c) - 2 * ends[f"lo_{c}"] + ends[f"hi_{c}"] + 1).alias(c) for c in features])
    data = vectors(moved, features).select(key, "features").persist()
    return _predict(BisectingKMeans(k=k, seed=seed).fit(data), data, key)


def mixture(df: DataFrame, key: str, features: Sequence[str], k: int, seed: int = 42, tied: bool = False, init: str = "kmeans") -> DataFrame:
    """Most likely component of a Gaussian mixture; ``tied`` components share one covariance."""
    data = points(df, key, features)
    return likeliest(data, key, features, mixtures(data, features, [Shape(k, tied, init)], seed)[0][0])


def cluster_counts(labelled: DataFrame) -> DataFrame:
    """Clusters found and points left as noise."""
    kept = F.when(F.col("cluster") != -1, F.col("cluster"))
    return labelled.agg(F.count_distinct(kept).alias("clusters"), F.count_if(F.col("cluster") == -1).alias("noise"))


#: Distances formed at once: so many rows against so many columns stay in the cache.
CHUNK_ROWS, CHUNK_COLUMNS = 32, 8192
#: Sums that leave a tile, and the rows of its sides.
TILE_SUMS, LEAST_SIDE, LARGEST_SIDE = 1 << 23, 512, 1 << 15


class _Side:
    """One side of a tile, its rows in the order of their clusters."""

    def __init__(self, rows: pd.DataFrame, cols: list[str]):
        rows = rows.sort_values("cluster", kind="stable")
        self.key, self.cluster = rows["key"].to_numpy(), rows["cluster"].to_numpy()
        self.x = np.ascontiguousarray(rows[cols].to_numpy(float).T)
        self.names, self.begins = np.unique(self.cluster, return_index=True)
        self.ends = np.append(self.begins[1:], len(rows))

    def sums(self, total: np.ndarray, other: _Side) -> pd.DataFrame:
        """A row for each row and cluster of the other side."""
        width = len(other.names)
        return pd.DataFrame({"key": np.repeat(self.key, width), "cluster": np.repeat(self.cluster, width),
                             "other": np.tile(other.names, len(self.key)), "total": total.ravel()})


def _summed_distances(a: _Side, b: _Side, both: bool) -> tuple[np.ndarray, np.ndarray]:
    """Of each row its summed distance to each cluster of the other side; those of ``b`` only if ``both``."""
    n, m = len(a.key), len(b.key)
    to_b, to_a = np.zeros((n, len(b.names))), np.zeros((len(a.names), m if both else 0))
    space, more = np.empty((2, CHUNK_ROWS * CHUNK_COLUMNS))
    for left in range(0, m, CHUNK_COLUMNS):
        right = min(left + CHUNK_COLUMNS, m)
        first, last = np.searchsorted(b.ends, left, "right"), np.searchsorted(b.begins, right)  # its clusters
        cuts = np.maximum(b.begins[first:last], left) - left
        y = b.x[:, None, left:right]
        for i, (begin, end) in enumerate(zip(a.begins, a.ends)):
            for low in range(begin, end, CHUNK_ROWS):
                high = min(low + CHUNK_ROWS, end)
                shape = high - low, right - left
                apart, side = (held[: shape[0] * shape[1]].reshape(shape) for held in (space, more))
                for f, (x, z) in enumerate(zip(a.x[:, low:high, None], y)):
                    to = side if f else apart
                    np.subtract(x, z, out=to)
                    np.multiply(to, to, out=to)
                    if f:
                        np.add(apart, side, out=apart)
                np.sqrt(apart, out=apart)
                to_b[low:high, first:last] += np.add.reduceat(apart, cuts, axis=1)
                if both:
                    to_a[i, left:right] += apart.sum(axis=0)
    return to_b, to_a.T


def silhouette(labelled: DataFrame, key: str, features: Sequence[str], tile: int | None = None) -> DataFrame:
    """One row: exact mean silhouette over the points that are not noise; -1 with fewer than two clusters.

    Blocks of at most ``tile`` rows follow the order of the clusters, so that a block holds few of them. Distances are summed per
    point and cluster inside tiles, each for both its points, so only those sums leave a task.
    """
    cols = list(features)
    points = labelled.where(F.col("cluster") != -1).select(
        F.col(key).alias("key"), "cluster", *[F.col(c).cast("double").alias(c) for c in cols]
    )
    points = number_rows(points, [F.col("cluster"), F.col("key")], "_block")
    n, k = points.agg(F.count(F.lit(1)), F.approx_count_distinct("cluster")).first()
    across = math.ceil(math.sqrt(8 * points.sparkSession.sparkContext.defaultParallelism))  # blocks that make some tiles for each core
    rows = tile or min(max(LEAST_SIDE, -(-n // across)), max(2048, min(LARGEST_SIDE, TILE_SUMS // max(k, 1))))
    points = points.withColumn("_block", F.floor(F.col("_block") / rows))

    def sums(a: pd.DataFrame, b: pd.DataFrame | None) -> pd.DataFrame:
        one = _Side(a, cols)
        two = one if b is None else _Side(b, cols)
        to_two, to_one = _summed_distances(one, two, b is not None)
        return one.sums(to_two, two) if b is None else pd.concat([one.sums(to_two, two), two.sums(to_one, one)], ignore_index=True)

    kind = dict(points.dtypes)["key"]
    part = tiled_self(points, "_block", max(1, -(-n // rows)), sums, f"key {kind}, cluster int, other int, total double")
    sizes = points.groupBy(F.col("cluster").alias("other")).agg(F.count(F.lit(1)).alias("n"))
    each = part.groupBy("key", "cluster", "other").agg(F.sum("total").alias("total")).join(sizes, "other")
    same = F.col("cluster") == F.col("other")
    per_point = each.groupBy("key").agg(
        F.max(F.when(same & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~same, F.col("total") / F.col("n"))).alias("b"),
        F.count(F.lit(1)).alias("clusters"),
    )
    width = F.when(F.col("a").isNull(), 0.0).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    )
    score = F.when(F.max("clusters") >= 2, F.avg(width)).otherwise(NO_SCORE)
    return per_point.agg(F.coalesce(score, F.lit(NO_SCORE)).alias("silhouette"))


def moments(labelled: DataFrame, features: Sequence[str]) -> DataFrame:
    """Of each cluster that is not noise: its points, their sum in each feature and their summed squared length."""
    kept = labelled.where(F.col("cluster") != -1)
    length = reduce(lambda a, b: a + b, [F.col(c) * F.col(c) for c in features])
    return kept.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(c) for c in features]).alias("total"), F.sum(length).alias("squares"))


def squared_widths(labelled: DataFrame, features: Sequence[str]) -> DataFrame:
    """The points that are not noise with their silhouette ``width`` under squared distance, and the number of ``clusters``.

    A point's mean squared distance to a cluster follows from the cluster's moments, so one aggregate and one pass over the points
    do, and all clusters' moments go with the pass (a row for each cluster). Far from the origin the moments cancel: scale or
    centre the features first.
    """
    of = F.struct("cluster", "n", "total", "squares")
    table = moments(labelled, features).agg(F.sort_array(F.collect_list(of)).alias("m"))
    point = F.array(*[F.col(c).cast("double") for c in features])
    length = reduce(lambda a, b: a + b, [F.col(c) * F.col(c) for c in features])

    def total(c: Column) -> Column:
        """Summed squared distance of the row to the points of a cluster."""
        dot = F.aggregate(F.zip_with("_x", c["total"], lambda p, q: p * q), F.lit(0.0), lambda at, v: at + v)
        return F.greatest(c["n"] * F.col("_length") + c["squares"] - 2 * dot, F.lit(0.0))

    rows = labelled.where(F.col("cluster") != -1).withColumns({"_x": point, "_length": length, "_m": table.scalar()})
    own = F.filter("_m", lambda c: c["cluster"] == F.col("cluster"))[0]
    others = F.filter("_m", lambda c: c["cluster"] != F.col("cluster"))
    rows = rows.withColumns({
        "_a": F.when(own["n"] > 1, total(own) / (own["n"] - 1)),
        "_b": F.array_min(F.transform(others, lambda c: total(c) / c["n"])),
    })
    width = F.when(F.col("_a").isNull(), 0.0).otherwise(
        F.coalesce(F.try_divide(F.col("_b") - F.col("_a"), F.greatest("_a", "_b")), F.lit(0.0)))
    return rows.select(*labelled.columns, width.alias("width"), F.size("_m").alias("clusters"))


def silhouette_squared(labelled: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row: mean silhouette under squared distance of the points that are not noise; -1 with fewer than two clusters."""
    score = F.when(F.max("clusters") >= 2, F.avg("width")).otherwise(NO_SCORE)
    return squared_widths(labelled, features).agg(F.coalesce(score, F.lit(NO_SCORE)).alias("silhouette"))


def centroids(labelled: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean point, size and mean distance to it of each cluster that is not noise."""
    kept = labelled.where(F.col("cluster") != -1)
    middle = kept.groupBy("cluster").agg(*[F.avg(c).alias(f"m_{c}") for c in features])
    gap = F.sqrt(reduce(lambda a, b: a + b, [(F.col(c) - F.col(f"m_{c}")) ** 2 for c in features]))
    scatter = kept.join(middle, "cluster").groupBy("cluster").agg(
        F.avg(gap).alias("scatter"), F.sum(gap * gap).alias("within"), F.count(F.lit(1)).alias("n")
    )
    return middle.join(scatter, "cluster")


def davies_bouldin(labelled: DataFrame, features: Sequence[str], missing: float = NO_SCORE, tile: int = TILE_ROWS) -> DataFrame:
    """One row: mean over clusters of the worst scatter-to-separation ratio; ``missing`` below two clusters."""
    cols = [f"m_{c}" for c in features]
    middle = cut_lineage(centroids(labelled, features).select("cluster", "scatter", *cols))

    def worst(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        apart = np.sqrt(((a[cols].to_numpy()[:, None, :] - b[cols].to_numpy()[None, :, :]) ** 2).sum(axis=2))
        spread = a["scatter"].to_numpy()[:, None] + b["scatter"].to_numpy()[None, :]
        ratio = np.divide(spread, apart, out=np.zeros_like(spread), where=apart > 0)
        return pd.DataFrame({"cluster": a["cluster"].to_numpy(), "ratio": ratio.max(axis=1) if len(b) else 0.0})

    ratios = tiled(middle, middle, "cluster", "cluster", worst, "cluster int, ratio double", tile)
    score = ratios.groupBy("cluster").agg(F.max("ratio").alias("ratio"))
    return score.agg(
        F.when(F.count(F.lit(1)) >= 2, F.avg("ratio")).otherwise(missing).alias("davies_bouldin")
    )


def calinski_harabasz(labelled: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row: between-cluster over within-cluster dispersion, each per degree of freedom."""
    kept = labelled.where(F.col("cluster") != -1)
    whole = one_row(kept.agg(*[F.avg(c).alias(f"m_{c}") for c in features], F.count(F.lit(1)).alias("n")))
    away = reduce(lambda a, b: a + b, [(F.col(f"m_{c}") - whole[f"m_{c}"]) ** 2 for c in features])
    sums = centroids(labelled, features).agg(
        F.sum(F.col("n") * away).alias("between"), F.sum("within").alias("within"),
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"),
    )
    ratio = F.try_divide(F.col("between") * (F.col("n") - F.col("k")), F.col("within") * (F.col("k") - 1))
    return sums.select(ratio.alias("calinski_harabasz"))


def scores(labelled: DataFrame, key: str, features: Sequence[str], exact: bool = False) -> tuple[float, float]:
    """Silhouette and Davies-Bouldin of a labelling; both -1 with fewer than two clusters.

    The silhouette is that of squared distances, from the clusters' moments; ``exact`` takes all plain distances, which costs the
    square of the rows.
    """
    fixed = cut_lineage(labelled)
    width = (silhouette(fixed, key, features) if exact else silhouette_squared(fixed, features)).first()[0]
    return width, (davies_bouldin(fixed, features).first()[0] if width != NO_SCORE else NO_SCORE)


# Parameter grids, three parameters of two values for each algorithm.
CLUSTER_GRID = {
    "KMeans": {"n_clusters": [3, 5], "init": ["k-means++", "random"], "n_init": [10, 20]},
    "DBSCAN": {"eps": [0.5, 1.0], "min_samples": [2, 4], "metric": ["euclidean", "manhattan"]},
    "Hierarchical": {"n_clusters": [3, 5], "linkage": ["average", "complete"], "metric": ["euclidean", "manhattan"]},
    "GMM": {"n_components": [3, 5], "covariance_type": ["full", "tied"], "init_params": ["kmeans", "random"]},
}


def fit_labels(df: DataFrame, key: str, features: Sequence[str], configs: Sequence[tuple[str, dict]], seed: int = 42) -> list[DataFrame]:
    """``key, cluster`` of each configuration. Those of one algorithm are fitted together, in the same passes over the points."""
    data, out = points(df, key, features), [None] * len(configs)
    chosen = {name: [(i, p) for i, (algorithm, p) in enumerate(configs) if algorithm == name] for name, _ in configs}
    for name, own in chosen.items():
        if name == "KMeans":
            starts = sorted({Start(p["n_clusters"], p.get("init", "k-means++"), seed + i) for _, p in own for i in range(p.get("n_init", 1))})
            found = kmeans_starts(data, features, starts)
            for i, p in own:
                seeds = [starts.index(Start(p["n_clusters"], p.get("init", "k-means++"), seed + j)) for j in range(p.get("n_init", 1))]
                out[i] = nearest_centre(data, key, features, best_start(found, seeds))
        elif name == "GMM":
            shapes = [Shape(p["n_components"], p.get("covariance_type", "full") == "tied", p.get("init_params", "kmeans")) for _, p in own]
            for (i, _), (fitted, _) in zip(own, mixtures(data, features, shapes, seed)):
                out[i] = likeliest(data, key, features, fitted)
        elif name == "Hierarchical":
            shapes = [(p["n_clusters"], p.get("linkage", "average"), p.get("metric", "euclidean")) for _, p in own]
            for (i, _), labels in zip(own, hierarchies(data, key, features, shapes)):
                out[i] = labels
        elif name == "DBSCAN":
            with ThreadPoolExecutor(4) as pool:
                runs = [(i, pool.submit(dbscan, data, key, features, p["eps"], p["min_samples"], p.get("metric", "euclidean"))) for i, p in own]
                for i, run in runs:
                    out[i] = run.result()
        else:
            raise ValueError(f"unknown algorithm {name}")
    return out


def cluster_grid(df: DataFrame, key: str, features: Sequence[str], grid: dict | None = None, parallel: int = 4) -> DataFrame:
    """Run table of the grid, in configuration order, with quality scores and seconds.

    The configurations of an algorithm are fitted together, so each carries an equal part of its seconds; ``parallel`` labellings are scored at a time.
    """
    data = cut_lineage(df.select(key, *features))
    n, rows = data.count(), []
    for algorithm, options in (grid or CLUSTER_GRID).items():
        start = time.perf_counter()
        configs = [(algorithm, dict(zip(options, values))) for values in itertools.product(*options.values())]
        labels = [cut_lineage(found) for found in fit_labels(data, key, features, configs)]
        seconds = (time.perf_counter() - start) / len(configs)
        with ThreadPoolExecutor(parallel) as pool:
            scored = pool.map(lambda found: scores(data.join(unsent(found, n), key), key, features), labels)
            rows += [(algorithm, {k: str(v) for k, v in params.items()}, *both, seconds) for (_, params), both in zip(configs, scored)]
    return df.sparkSession.createDataFrame(
        [(i, *row) for i, row in enumerate(rows, 1)],
        "config int, algorithm string, params map<string,string>, silhouette double, davies_bouldin double, seconds double",
    )


# Price tiers of a bundle.
TIERS = [(12, "Budget Friendly"), (16, "Popular Favorites"), (20, "Premium Selection")]


def cluster_bundles(products: DataFrame, labels: DataFrame, item: str = "item_name", shown: int = 5) -> DataFrame:
    """Bundles from clusters with two or more items: first items by name, mean line price, lines and tier.

    ``products`` carries ``lines`` and ``unit_price_sum`` per item, so lines are not read again.
    """
    from salescope.operators.series import best_rows

    tagged = products.join(labels, item)
    totals = tagged.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("items"), F.sum("lines").alias("popularity"),
        (F.sum("unit_price_sum") / F.sum("lines")).alias("price"),
    )
    first = best_rows(tagged.select("cluster", item), ["cluster"], F.col(item), n=shown).groupBy("cluster").agg(
        F.array_sort(F.collect_list(item)).alias("members")
    )
    tier = F.lit("Gourmet Collection")
    for top, label in reversed(TIERS):
        tier = F.when(F.col("price") < top, label).otherwise(tier)
    take = F.least(F.size("members"), F.lit(3))
    return totals.where(F.col("items") >= 2).join(first, "cluster").select(
        "cluster", tier.alias("bundle_type"), "members", F.round("price", 2).alias("avg_price"), "popularity",
        F.format_string("Offer %d of its items together", take).alias("recommendation"),
    )
