"""Agglomerative clustering (average or complete linkage) over bounded summaries.

Tasks reduce their points to at most ``most`` summaries (count, centre, mean squared distance to it): a point joins the nearest summary if
the joint radius stays within a threshold, else it begins a new one; when there are too many, the threshold doubles and the summaries
are joined again. Tasks' summaries are merged in the same way, some at a time, until one set is left, which alone is linked. While there
are no more distinct points than ``most``, every one is its own summary and the result is that of exact linkage.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from salescope.session import cut_lineage

MOST = 1024
#: Sets of summaries that are merged in one task.
FAN = 8


class Summaries:
    """At most ``most`` summaries."""

    def __init__(self, d: int, most: int, threshold: float = 0.0):
        self.most, self.threshold, self.size = most, threshold, 0
        self.n, self.centre, self.spread = np.zeros(most + 1), np.zeros((most + 1, d)), np.zeros(most + 1)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.n[: self.size], self.centre[: self.size], self.spread[: self.size]

    def add(self, n: float, centre: np.ndarray, spread: float) -> None:
        if self.size:
            away = ((self.centre[: self.size] - centre) ** 2).sum(1)
            at = int(away.argmin())
            whole = self.n[at] + n
            joint = (self.n[at] * self.spread[at] + n * spread) / whole + self.n[at] * n / whole**2 * away[at]
            if away[at] == 0 or joint <= self.threshold**2:
                self.centre[at] += (centre - self.centre[at]) * (n / whole)
                self.n[at], self.spread[at] = whole, joint
                return
        self.n[self.size], self.centre[self.size], self.spread[self.size] = n, centre, spread
        self.size += 1
        if self.size > self.most:
            self._tighten()

    def _tighten(self) -> None:
        """Double the threshold until summaries join."""
        n, centre, spread = (a.copy() for a in self.rows())
        if not self.threshold:
            away = ((centre[:, None] - centre[None]) ** 2).sum(2)
            np.fill_diagonal(away, np.inf)
            self.threshold = float(np.sqrt(away.min())) / 4
        while True:
            self.threshold *= 2
            smaller = Summaries(centre.shape[1], len(n), self.threshold)
            for row in zip(n, centre, spread):
                smaller.add(*row)
            if smaller.size <= self.most // 2 + 1:
                break
        self.size = smaller.size
        for own, new in ((self.n, smaller.n), (self.centre, smaller.centre), (self.spread, smaller.spread)):
            own[: self.size] = new[: self.size]


def _frame(held: Summaries, cols: Sequence[str], group: int) -> pd.DataFrame:
    n, centre, spread = held.rows()
    return pd.DataFrame(centre, columns=list(cols)).assign(_n=n, _spread=spread, _least=held.threshold, _group=group)


def summarised(data: DataFrame, features: Sequence[str], most: int = MOST) -> pd.DataFrame:
    """The summaries of all rows (features, ``_n``, ``_spread``), at most ``most``, in the order of their coordinates."""
    from pyspark import TaskContext

    cols = list(features)
    schema = ", ".join([*[f"`{c}` double" for c in cols], "_n double, _spread double, _least double, _group long"])

    def per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = Summaries(len(cols), most)
        for batch in batches:
            x, n = np.unique(batch[cols].to_numpy(float), axis=0, return_counts=True)
            for row, count in zip(x, n):
                held.add(float(count), row, 0.0)
        if held.size:
            yield _frame(held, cols, TaskContext.get().partitionId())

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        held = Summaries(len(cols), most, float(rows["_least"].max()))
        for row, n, spread in zip(rows[cols].to_numpy(float), rows["_n"], rows["_spread"]):
            held.add(n, row, spread)
        return _frame(held, cols, int(rows["_group"].iat[0]) // FAN)

    sets = cut_lineage(data.select(*[F.col(c).cast("double").alias(c) for c in cols]).mapInPandas(per_task, schema))
    while True:
        top = sets.agg(F.max("_group")).first()[0]
        if not top:
            break
        sets = cut_lineage(sets.groupBy(F.floor(F.col("_group") / FAN)).applyInPandas(merged, schema))
    return sets.toPandas().sort_values(cols, ignore_index=True)


def linked(centres: np.ndarray, weights: np.ndarray, linkage: str, metric: str, ks: Sequence[int]) -> dict[int, np.ndarray]:
    """Labels of the summaries for each number of clusters, numbered by their first summary. Ties go to the first pair."""
    gaps = np.abs(centres[:, None] - centres[None])
    away = gaps.sum(2) if metric == "manhattan" else np.sqrt((gaps**2).sum(2))
    np.fill_diagonal(away, np.inf)
    owner, n, left, out = np.arange(len(centres)), weights.astype(float), len(centres), {}
    while True:
        if left in ks or (left <= 1 or left == len(centres)) and any(k >= left for k in ks):
            labels = np.unique(owner, return_inverse=True)[1].astype(np.int32)
            out.update({k: labels for k in ks if k == left or (k > left and k not in out)})
        if left <= max(1, min(ks)):
            return out
        a, b = sorted(divmod(int(away.argmin()), len(away)))
        if linkage == "complete":
            joint = np.maximum(away[a], away[b])
        else:
            joint = (n[a] * away[a] + n[b] * away[b]) / (n[a] + n[b])
        joint[[a, b]] = np.inf
        away[a], away[:, a] = joint, joint
        away[b], away[:, b] = np.inf, np.inf
        owner[owner == b] = a
        n[a] += n[b]
        left -= 1


def hierarchies(data: DataFrame, key: str, features: Sequence[str], shapes: Sequence[tuple[int, str, str]], most: int = MOST) -> list[DataFrame]:
    """``key, cluster`` for each (clusters, linkage, metric); all share one set of summaries. A row has its nearest summary's label."""
    from salescope.operators.centroids import _labelled, _squares

    table = summarised(data, features, most)
    centres, n = table[list(features)].to_numpy(float), table["_n"].to_numpy()
    trees = {}
    for linkage, metric in {(linkage, metric) for _, linkage, metric in shapes}:
        ks = sorted({k for k, *kind in shapes if tuple(kind) == (linkage, metric)})
        trees[linkage, metric] = linked(centres, n, linkage, metric, ks)
    return [
        _labelled(data, key, features, lambda x, labels=trees[linkage, metric][k]: labels[_squares(x, centres).argmin(1)])
        for k, linkage, metric in shapes
    ]
