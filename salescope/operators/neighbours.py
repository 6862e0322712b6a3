"""k-nearest-neighbour regression and classification.

The training rows form a tree of cells. A row first meets the cell near it; its k-th best distance there bounds the search, and only rows
whose bound reaches into other cells' boxes go on, to just those cells. Results are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from salescope.operators import cells
from salescope.session import cut_lineage

#: Equal training points are dealt to so many parts before the ``k`` of lowest key are taken.
PARTS = 64
#: Training rows in a cell that is not cut further.
LEAF = cells.LEAF
#: A little more than a computed bound, as distances are rounded.
SLACK = 1 + 1e-9
BLOCK = 1 << 20


def lowest_keys(train: DataFrame, k: int) -> DataFrame:
    """Of equal points the ``k`` of lowest key: others can't be among the nearest of any row."""
    part = F.pmod(F.xxhash64("train_key"), F.lit(PARTS))
    first = W.partitionBy("x", part).orderBy("train_key")
    few = train.withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= k)
    return few.withColumn("_k", F.row_number().over(W.partitionBy("x").orderBy("train_key"))).where(F.col("_k") <= k).drop("_k")


def _closest(k: int, p: int):
    """Per part of a cell: the ``k`` best of each row within its ``reach``."""

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"key": a["key"][:0], "train_key": b["train_key"][:0], "distance": np.zeros(0), "value": np.zeros(0)})
        if not len(a) or not len(b):
            return empty
        b = b.sort_values("train_key", kind="stable")
        x, y = np.stack(a["x"].to_numpy()), np.stack(b["x"].to_numpy())
        near, kept, step = min(k, len(b)), [], max(1, BLOCK // (len(b) * x.shape[1]))
        for start in range(0, len(x), step):
            away = np.abs(x[start : start + step, None, :] - y[None, :, :])
            distance = away.sum(axis=2) if p == 1 else np.sqrt((away**2).sum(axis=2))
            # the near ones and, of those as far as the last of them, the first: without ordering all
            last = np.partition(distance, near - 1, axis=1)[:, near - 1 : near]
            last = np.where(np.isnan(last), np.inf, last)  # fewer than that many distances are numbers
            closer, level = distance < last, distance == last
            inside = closer | level & (np.cumsum(level, axis=1, dtype=np.int32) <= near - closer.sum(axis=1, keepdims=True))
            rows, columns = np.nonzero(inside & (distance <= a["reach"].to_numpy()[start : start + step, None]))
            kept.append(pd.DataFrame({
                "key": a["key"].to_numpy()[start + rows], "train_key": b["train_key"].to_numpy()[columns],
                "distance": distance[rows, columns], "value": b["value"].to_numpy()[columns]}))
        return pd.concat(kept)

    return compare


def search(visits: DataFrame, points: DataFrame, k: int, p: int) -> DataFrame:
    """The ``k`` best in its cell of each visit (key, x, cell, reach), no farther than its reach."""
    kinds = dict(visits.dtypes)["key"], dict(points.dtypes)["train_key"]
    a, b = cells.meet(visits, points)
    return a.groupBy("cell", "part").cogroup(b.groupBy("cell", "part")).applyInPandas(
        _closest(k, p), f"key {kinds[0]}, train_key {kinds[1]}, distance double, value double")


def further(test: DataFrame, first: DataFrame, tree: cells.Tree, k: int, metric: str) -> DataFrame:
    """The rows whose k-th best distance so far reaches other cells, one for each such cell."""
    bound = first.groupBy("key").agg(F.max("distance").alias("far"), F.count(F.lit(1)).alias("found"))
    reach = F.least("reach", F.when(F.col("found") >= k, F.col("far")).otherwise(F.col("reach"))) * SLACK
    bounded = test.withColumnRenamed("cell", "seen").join(bound, "key", "left").select("key", "x", reach.alias("reach"), "seen")
    limit = F.col("reach") if metric == "manhattan" else F.col("reach") * F.col("reach") * SLACK
    return tree.within(bounded, limit, metric).where(F.col("cell") != F.col("seen")).drop("seen")


def nearest(train: DataFrame, test: DataFrame, features: Sequence[str], target: str, key: str, k: int,
            p: int = 2, leaf: int | None = None) -> DataFrame:
    """The ``k`` closest training rows of each test row (ties: lowest training key), exact."""
    metric = "manhattan" if p == 1 else "euclidean"
    point = F.array(*[F.col(c).cast("double") for c in features]).alias("x")
    right = train.select(F.col(key).alias("train_key"), F.col(target).cast("double").alias("value"), point)
    tree = cells.build(lowest_keys(right, k), len(features), max(leaf or LEAF, 4 * k))
    left = tree.home(test.select(F.col(key).alias("key"), point), metric, k).withColumn("reach", F.col("reach") * SLACK)
    if tree.depth:
        left = cut_lineage(left)
    found = search(left, tree.points, k, p)
    if tree.depth:  # with a single cell all is decided
        found = cut_lineage(found)
        found = found.unionByName(search(cut_lineage(further(left, found, tree, k, metric)), tree.points, k, p))
    rank = F.row_number().over(W.partitionBy("key").orderBy("distance", "train_key"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def knn_regression(train: DataFrame, test: DataFrame, features: Sequence[str], target: str, key: str, k: int = 5,
                   weights: str = "uniform", p: int = 2) -> DataFrame:
    """Mean of the neighbours' target, uniform or by inverse distance (exact matches win alone)."""
    near = nearest(train, test, features, target, key, k, p)
    exact = F.col("distance") == 0
    by_distance = F.coalesce(
        F.avg(F.when(exact, F.col("value"))),
        F.sum(F.when(~exact, F.col("value") / F.col("distance"))) / F.sum(F.when(~exact, 1 / F.col("distance"))),
    )
    mean = F.avg("value") if weights == "uniform" else by_distance
    return near.groupBy(F.col("key").alias(key)).agg(mean.alias("prediction"))


def knn_classification(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, key: str, k: int = 5,
                       p: int = 2) -> DataFrame:
    """Most frequent neighbour label (ties: smallest)."""
    near = nearest(train, test, features, label, key, k, p)
    votes = near.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy(F.col("key").alias(key)).agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("prediction"))
