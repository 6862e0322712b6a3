"""Density clustering (DBSCAN) over a tree of cells.

Equal points become one weighted point. Pairs of cells go down the tree together, from the root with itself: a pair farther apart than
``eps`` is dropped, a pair whose farthest corners are within ``eps`` is settled whole, by the weights of its boxes, and only pairs of
leaves that are neither are compared point by point, one pair in a task at a time. So a crowd in one place is settled by a few boxes,
whatever its size and the number of dimensions, and no pairs of its points are formed. A leaf whose boxes settled whole already hold
``min_samples`` is not counted any further. Comparisons pass on a star for each connected group they find, not their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from salescope.operators import cells
from salescope.operators.ordered import running
from salescope.session import cut_lineage, unsent

LEAF = 512
#: Pairs of leaves that are compared in one task.
TASK_PAIRS = 256


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links with the least node it reaches, but for those least nodes themselves."""
    names, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(names))
    return names[moved], names[root[moved]]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (u, v) edges: each node with the smallest node it reaches.

    Tasks first reduce their own edges to stars; alternating star contraction then joins these. The number of rounds grows with the
    logarithm of the graph.
    """

    def reduce_own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(batches)
        if held:
            u, v = stars(*(np.concatenate([b[c].to_numpy() for b in held]) for c in ("u", "v")))
            yield pd.DataFrame({"u": u, "v": v})

    links = cut_lineage(edges.mapInPandas(reduce_own, "u long, v long").distinct())
    print_of = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = print_of(links)
    while True:
        rows = seen[0]
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        roots = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(unsent(roots, rows), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(unsent(lowest, rows), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = cut_lineage(
            small.union(lowest.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct()
        )
        now = print_of(links)
        if now == seen:
            return links.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
        seen = now


def _apart(a: str, b: str, metric: str, farthest: bool) -> Column:
    """Least or greatest distance between two boxes."""
    def minus(x: str, y: str) -> Column:
        return F.zip_with(F.col(x), F.col(y), lambda p, q: p - q)

    one, two = (minus(f"{b}.hi", f"{a}.lo"), minus(f"{a}.hi", f"{b}.lo")) if farthest else (minus(f"{b}.lo", f"{a}.hi"), minus(f"{a}.lo", f"{b}.hi"))
    sides = F.zip_with(one, two, lambda p, q: F.greatest(p, q) if farthest else F.greatest(p, q, F.lit(0.0)))
    size = cells.norm(sides, metric)
    return size if metric == "manhattan" else F.sqrt(size)


def close_pairs(tree: cells.Tree, eps: float, metric: str) -> DataFrame:
    """Unordered pairs of cells ``a``, ``b`` with their weights: ``whole`` ones, and pairs of leaves to compare.

    Each pair of points within ``eps`` lies in exactly one of them.
    """
    node = F.struct("cell", "lo", "hi", "weight", "inner")
    children = tree.nodes.where("parent is not null").groupBy("parent").agg(F.collect_list(node).alias("children"))
    children = cells.small(children, tree.count)
    pairs = tree.nodes.where(F.col("cell") == cells.ROOT).select(node.alias("a"), node.alias("b"))
    settled = []
    for level in range(tree.depth + 1):
        whole = _apart("a", "b", metric, True) <= eps
        leaves = ~F.col("a.inner") & ~F.col("b.inner")
        judged = pairs.where(_apart("a", "b", metric, False) <= eps).withColumns({"whole": whole, "open": ~whole & ~leaves})
        judged = cut_lineage(judged)
        settled.append(judged.where(~F.col("open")).select(
            F.col("a.cell").alias("a"), F.col("b.cell").alias("b"), F.col("a.weight").alias("a_weight"), F.col("b.weight").alias("b_weight"), "whole"))
        if level == tree.depth:
            break
        pairs = judged.where("open").select("a", "b", (F.col("a.cell") == F.col("b.cell")).alias("same"))
        for side in ("a", "b"):
            met = pairs.join(children, F.col(f"{side}.cell") == F.col("parent"), "left")
            each = F.explode(F.when(F.col("children").isNull(), F.array(side)).otherwise(F.col("children"))).alias(side)
            pairs = met.select(*[c for c in ("a", "b", "same") if c != side], each)
        pairs = pairs.where(~F.col("same") | (F.col("a.cell") <= F.col("b.cell"))).select("a", "b")
    return cut_lineage(reduce(DataFrame.unionByName, settled).repartition("a", "b")) if tree.depth else settled[0]


def ancestors(cell: Column) -> Column:
    """A cell and all cells around it."""
    parts = F.split(cell, r"\.")
    inner = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "."))
    return F.array_distinct(F.concat(F.array(F.lit(cells.ROOT)), inner))


def both_ways(pairs: DataFrame) -> DataFrame:
    """Each pair from both sides, one of a cell with itself once."""
    turned = pairs.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("b_weight").alias("a_weight"), F.col("a_weight").alias("b_weight"))
    return pairs.select("a", "b", "a_weight", "b_weight").unionByName(turned)


def _dealt(pairs: DataFrame, points: DataFrame, names: Sequence[str], rows: int) -> DataFrame:
    """The ``points`` (``rows`` of them) of both cells of each pair, with a task for each ``TASK_PAIRS`` pairs or so."""
    tasks = max(1, pairs.count() // TASK_PAIRS)
    dealt = pairs.withColumn("task", F.pmod(F.xxhash64("a", "b"), F.lit(tasks)))
    sides = [
        dealt.join(unsent(points, rows), F.col(side) == F.col("cell")).select("task", "a", "b", F.lit(i).alias("side"), *names)
        for i, side in enumerate(("a", "b"))
    ]
    return sides[0].unionByName(sides[1].where("a <> b"))


def _within(x: np.ndarray, y: np.ndarray, eps: float, metric: str) -> np.ndarray:
    away = np.abs(x[:, None, :] - y[None, :, :])
    return (away.sum(axis=2) if metric == "manhattan" else np.sqrt((away**2).sum(axis=2))) <= eps


def _pairs_of(frame: pd.DataFrame, names: Sequence[str]) -> Iterator[tuple[list[np.ndarray], list[np.ndarray], bool]]:
    """The columns of both sides of each pair, and whether they are one cell."""
    a, b, side = pd.factorize(frame["a"])[0], pd.factorize(frame["b"])[0], frame["side"].to_numpy()
    same = (frame["a"] == frame["b"]).to_numpy()
    order = np.lexsort((side, b, a))
    a, b, side, same = a[order], b[order], side[order], same[order]
    columns = [(np.stack(frame[c].to_numpy()) if c == "x" else frame[c].to_numpy())[order] for c in names]
    cuts = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
    for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(a)]):
        middle = begin + int((side[begin:end] == 0).sum())
        left = [c[begin:middle] for c in columns]
        yield left, left if same[begin] else [c[middle:end] for c in columns], bool(same[begin])


def _counting(eps: float, metric: str):
    def count(frame: pd.DataFrame) -> pd.DataFrame:
        nodes, counts = [], []
        for (x, node, w), (y, other, v), same in _pairs_of(frame, ["x", "node", "w"]):
            near = _within(x, y, eps, metric)
            nodes.append(node)
            counts.append(near @ v)
            if not same:
                nodes.append(other)
                counts.append(near.T @ w)
        return pd.DataFrame({"node": np.concatenate(nodes), "c": np.concatenate(counts)})

    return count


def _grouped(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least row that each row and each column of a table hangs together with; the number of rows for a column without any."""
    high = len(near)
    label = np.arange(high)
    while True:
        column = np.where(near, label[:, None], high).min(0, initial=high)
        new = np.minimum(label, np.where(near, column[None, :], high).min(1, initial=high))
        if (new == label).all():
            return label, column
        label = new


def _linking(eps: float, metric: str):
    def link(frame: pd.DataFrame) -> pd.DataFrame:
        found = []

        def add(u: np.ndarray, v: np.ndarray, border: bool) -> None:
            found.append(pd.DataFrame({"u": u, "v": v, "border": border}))

        add(np.zeros(0, np.int64), np.zeros(0, np.int64), False)
        for (x, a, p), (y, b, q), same in _pairs_of(frame, ["x", "node", "core"]):
            p, q, near = p.astype(bool), q.astype(bool), _within(x, y, eps, metric)
            rows, columns = _grouped(near[np.ix_(p, q)])
            linked = columns < p.sum()
            heads = np.full(p.sum() + 1, np.iinfo(np.int64).max)
            np.minimum.at(heads, rows, a[p])
            np.minimum.at(heads, columns[linked], b[q][linked])
            ours, theirs = heads[rows], np.where(linked, heads[columns], b[q])
            add(a[p][a[p] != ours], ours[a[p] != ours], False)
            if not same:
                add(b[q][b[q] != theirs], theirs[b[q] != theirs], False)
            for hits, edge, head in ((near[np.ix_(~p, q)], a[~p], theirs), (near[np.ix_(p, ~q)].T, b[~q], ours)):
                i, j = np.nonzero(hits)
                if len(i):
                    both = np.unique(np.stack([edge[i], head[j]], 1), axis=0)
                    add(both[:, 0], both[:, 1], True)
        return pd.concat(found)

    return link


def _links_of_whole(near: DataFrame, points: DataFrame, rows: int, nodes: int) -> list[DataFrame]:
    """In a cell that lies whole within reach of core points, all core points hang together and all others are borders."""
    inside = points.select("node", "core", F.explode(ancestors(F.col("cell"))).alias("cell")).join(
        cells.small(near.select("cell").distinct(), nodes), "cell")
    heads = inside.where("core").groupBy("cell").agg(F.min("node").alias("head"))
    reached = near.join(heads.select(F.col("cell").alias("other"), F.col("head").alias("v")), "other").select("cell", "v").distinct()
    bonds = inside.where("core").join(cells.small(reached.select("cell").distinct(), nodes), "cell").join(
        cells.small(heads, nodes), "cell").select(F.col("node").alias("u"), F.col("head").alias("v"))
    across = reached.join(heads, "cell").select(F.col("head").alias("u"), "v")
    edges = unsent(inside.where("not core"), rows).join(reached, "cell").select(F.col("node").alias("u"), "v")
    return [bonds.union(across).where("u <> v").withColumn("border", F.lit(False)), edges.withColumn("border", F.lit(True))]


def dbscan(df: DataFrame, key: str, features: Sequence[str], eps: float, min_samples: int,
           metric: str = "euclidean", leaf: int = LEAF) -> DataFrame:
    """(key, cluster): clusters numbered from 0 by their lowest core key, -1 for noise.

    A point counts itself; a border point joins the lowest-numbered cluster in reach.
    ``key`` is a unique number.
    """
    rows = df.count()
    source = df.select(F.col(key).cast("long").alias("key"), F.array(*[F.col(f).cast("double") + 0.0 for f in features]).alias("x"))
    tree = cells.build(source.groupBy("x").agg(F.min("key").alias("node"), F.count(F.lit(1)).alias("w")), len(features), leaf, weight="w")
    pairs = close_pairs(tree, eps, metric)
    whole, direct = pairs.where("whole").drop("whole"), pairs.where("not whole").drop("whole")
    any_whole, any_direct = pairs.agg(F.count_if("whole") > 0, F.count_if(~F.col("whole")) > 0).first()

    points = tree.points.withColumns({"held": F.lit(0).cast("long"), "c": F.lit(0).cast("long")})
    if any_whole:
        held = both_ways(whole).groupBy(F.col("a").alias("node")).agg(F.sum("b_weight").alias("held"))
        around = tree.leaves().select("cell", F.explode(ancestors(F.col("cell"))).alias("node"))
        sure = cut_lineage(around.join(held, "node", "left").groupBy("cell").agg(F.coalesce(F.sum("held"), F.lit(0)).alias("held")))
        points = points.drop("held").join(sure, "cell")
    if any_direct:
        asked = direct
        if any_whole:
            unsure = sure.where(F.col("held") < min_samples).select("cell")
            asked = direct.join(unsure.select(F.col("cell").alias("a"), F.lit(1).alias("one")), "a", "left").join(
                unsure.select(F.col("cell").alias("b"), F.lit(1).alias("two")), "b", "left").where("one is not null or two is not null")
        counted = _dealt(cut_lineage(asked.select("a", "b")), tree.points, ["node", "x", "w"], rows).groupBy("task").applyInPandas(_counting(eps, metric), "node long, c long")
        points = points.drop("c").join(unsent(counted.groupBy("node").agg(F.sum("c").alias("c")), rows), "node", "left")
    points = cut_lineage(points.select(
        "node", "x", "w", "cell", (F.col("held") + F.coalesce("c", F.lit(0)) >= min_samples).alias("core")))

    found = []
    if any_direct:
        found.append(_dealt(direct.select("a", "b"), points, ["node", "x", "core"], rows).groupBy("task").applyInPandas(
            _linking(eps, metric), "u long, v long, border boolean"))
    if any_whole:
        found += _links_of_whole(both_ways(whole).select(F.col("a").alias("cell"), F.col("b").alias("other")), points, rows, tree.count)
    found = cut_lineage(reduce(DataFrame.unionByName, found))

    roots = components(found.where("not border").select("u", "v"))
    core = points.where("core").select("node").join(unsent(roots, rows), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    core = cut_lineage(core)
    numbered = running(core.select("root").distinct(), "root", tie=["root"])
    labels = core.join(cells.small(numbered, numbered.count()), "root").select("node", (F.col("position") - 1).cast("int").alias("label"))
    border = found.where("border").join(unsent(labels.withColumnRenamed("node", "v"), rows), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("label"))
    by_point = points.select("x", "node").join(unsent(labels.unionByName(border), rows), "node", "left").select("x", "label")
    return source.join(unsent(by_point, rows), "x").select(F.col("key").alias(key), F.coalesce("label", F.lit(-1)).alias("cluster"))
