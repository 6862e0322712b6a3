"""A tree of cells over points, for searches that must stay exact without comparing all points.

Every cell with more than ``leaf`` points is cut along its widest sides: at quartiles and in the middle, or, if half of the points lie in
a small stretch of the side, into ``EVEN`` equal stretches, so that a crowd is set apart from a few points far off before it is cut itself.
Both part a cell's outermost points; points that are all equal stay in one cell, whatever their number. A cell's box is that of its own points. All cells of a
depth are cut in one pass over the points, so the number of passes grows with the logarithm of their number. Searches walk down
the tree a level at a time: the rows of a cell are dealt to tasks, each with the cell's at most ``EVEN`` ** ``SIDES`` children.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from salescope.session import cut_lineage, unsent

LEAF, SIDES, EVEN = 4096, 3, 8
#: Node tables of at most so many rows are broadcast.
FEW_NODES = 20_000
ROOT = ""
#: Distances of rows to boxes that are formed at once.
BLOCK = 1 << 18


def _sides(x: np.ndarray, boxes: np.ndarray, metric: str, farthest: bool) -> np.ndarray:
    """Least or greatest distance of each point to each box (lo, hi), squared for the euclidean metric."""
    out = np.zeros((len(x), len(boxes)))
    for i in range(x.shape[1]):
        below, above = boxes[None, :, 0, i] - x[:, None, i], x[:, None, i] - boxes[None, :, 1, i]
        side = np.maximum(-below, -above) if farthest else np.maximum(np.maximum(below, above), 0.0)
        out += side if metric == "manhattan" else side * side
    return out


def norm(sides: Column, metric: str) -> Column:
    """Sum of sides, of their squares for the euclidean metric."""
    return F.aggregate(sides, F.lit(0.0), (lambda at, s: at + s) if metric == "manhattan" else (lambda at, s: at + s * s))


def small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= FEW_NODES else unsent(df, rows)


class Tree:
    """Points with their ``cell``, the nodes (parent, cell, n, weight, lo, hi, inner), the tree's depth and its number of nodes."""

    def __init__(self, points: DataFrame, nodes: DataFrame, depth: int, count: int):
        self.points, self.nodes, self.depth, self.count = points, nodes, depth, count

    def leaves(self) -> DataFrame:
        return self.nodes.where(~F.col("inner")).drop("parent", "inner")

    def _descend(self, rows: DataFrame, step: Callable[[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray], pd.DataFrame]) -> DataFrame:
        """``rows`` with their ``cell``, from the root to leaves: a level at a time, the rows of a cell meet its children in parts.

        ``step(rows, points, boxes, sizes)`` gives the rows of the next level with their ``child`` (its place among the boxes).
        """
        children = self.nodes.where("parent is not null").select(F.col("parent").alias("cell"), F.col("cell").alias("child"), "n", "lo", "hi", "inner")
        going = rows.withColumns({"cell": F.lit(ROOT), "inner": F.lit(True)})
        schema, names, done = ", ".join(f"`{c}` {kind}" for c, kind in going.dtypes), going.columns, []

        def next_level(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if not len(a) or not len(b):
                return a[names][:0]
            b = b.sort_values("child")
            x, boxes, kept = np.stack(a["x"].to_numpy()), np.stack([np.stack(b[c].to_numpy()) for c in ("lo", "hi")], 1), []
            cell, inner, at_once = b["child"].to_numpy(), b["inner"].to_numpy(), max(1, BLOCK // len(b))
            for start in range(0, len(a), at_once):
                moved = step(a.iloc[start : start + at_once], x[start : start + at_once], boxes, b["n"].to_numpy())
                kept.append(moved.assign(cell=cell[moved["child"]], inner=inner[moved["child"]])[names])
            return pd.concat(kept)

        for _ in range(self.depth):
            left, right = meet(going, children)
            level = cut_lineage(left.groupBy("cell", "part").cogroup(right.groupBy("cell", "part")).applyInPandas(next_level, schema))
            done.append(level.where(~F.col("inner")))
            going = level.where("inner")
        return reduce(DataFrame.unionByName, done or [going]).drop("inner")

    def home(self, rows: DataFrame, metric: str, k: int) -> DataFrame:
        """``rows`` (with ``x``), a leaf ``cell`` near each, down the tree by the nearest child, and ``reach``: a distance that holds ``k`` points.

        The distance is read off the boxes on the way: the nearest ones that hold ``k`` points together, each at its farthest corner.
        """
        def nearest(a: pd.DataFrame, x: np.ndarray, boxes: np.ndarray, n: np.ndarray) -> pd.DataFrame:
            far = _sides(x, boxes, metric, True)
            order = np.argsort(far, axis=1)
            held = np.cumsum(n[order], axis=1) >= k
            at = np.take_along_axis(order, held.argmax(1)[:, None], 1)
            holds = np.where(held.any(1), np.take_along_axis(far, at, 1)[:, 0], np.inf)
            gap = _sides(x, boxes, metric, False)
            return a.assign(child=np.where(np.isnan(gap), np.inf, gap).argmin(1), reach=np.fmin(a["reach"].to_numpy(), holds))

        out = self._descend(rows.withColumn("reach", F.lit(float("inf"))), nearest).select(*rows.columns, "cell", "reach")
        return out if metric == "manhattan" else out.withColumn("reach", F.sqrt("reach"))

    def within(self, rows: DataFrame, reach: Column, metric: str) -> DataFrame:
        """``rows`` (with ``x``) for each leaf ``cell`` whose box is within ``reach`` of the point."""
        def reached(a: pd.DataFrame, x: np.ndarray, boxes: np.ndarray, n: np.ndarray) -> pd.DataFrame:
            row, child = np.nonzero(_sides(x, boxes, metric, False) <= a["_limit"].to_numpy()[:, None])
            return a.iloc[row].assign(child=child)

        return self._descend(rows.withColumn("_limit", reach), reached).select(*rows.columns, "cell")


def _cuts(side: Column) -> Column:
    """Where a side (lo, hi, quarters) is cut."""
    width, quarters = side["hi"] - side["lo"], side["quarters"]
    even = F.array(*[side["lo"] + width * (i / EVEN) for i in range(1, EVEN)])
    return F.when((quarters[2] - quarters[0]) * EVEN < width, even).otherwise(F.concat(quarters, F.array(side["lo"] + width / 2)))


def build(points: DataFrame, d: int, leaf: int = LEAF, weight: str | None = None) -> Tree:
    """The tree over ``points`` with a coordinate array ``x`` of length ``d``; nodes sum the column ``weight``, if there is one."""
    names = points.columns
    rows = cut_lineage(points.select(*names, F.lit(ROOT).alias("cell"), F.lit(None).cast("string").alias("parent")))
    done, levels, depth, count = [], [], 0, 0
    at = [F.col("x")[i] for i in range(d)]
    while True:
        ends = rows.groupBy("parent", "cell").agg(
            F.count(F.lit(1)).alias("n"), F.sum(weight or F.lit(1)).cast("long").alias("weight"), F.array(*[F.min(c) for c in at]).alias("lo"), F.array(*[F.max(c) for c in at]).alias("hi"),
            F.array(*[F.percentile_approx(c, [0.25, 0.5, 0.75], 500) for c in at]).alias("quarters"))
        sides = F.transform(F.arrays_zip("lo", "hi", "quarters"), lambda s, i: F.struct((s["hi"] - s["lo"]).alias("width"), i.alias("i"), _cuts(s).alias("cuts")))
        widest = F.array_max(F.transform(sides, lambda s: s["width"]))
        wide = F.slice(F.sort_array(F.filter(sides, lambda s: (s["width"] > 0) & (2 * s["width"] >= widest)), asc=False), 1, SIDES)
        level = cut_lineage(ends.withColumn("sides", wide).select(
            "parent", "cell", "n", "weight", "lo", "hi", ((F.col("n") > leaf) & (F.size("sides") > 0)).alias("inner"), "sides"))
        levels.append(level.drop("sides"))
        split = level.where("inner").select("cell", "sides")
        total, cut = level.agg(F.count(F.lit(1)), F.count_if("inner")).first()
        count += total
        if not cut:
            done.append(rows.select(*names, "cell"))
            break
        split = small(split, cut)
        done.append(rows.join(split, "cell", "left_anti").select(*names, "cell"))
        place = F.transform("sides", lambda s: F.size(F.filter(s["cuts"], lambda c: c < F.get(F.col("x"), s["i"]))).cast("string"))
        rows = cut_lineage(rows.join(split, "cell").select(
            *names, F.concat_ws(".", F.nullif("cell", F.lit(ROOT)), F.concat_ws("", place)).alias("cell"), F.col("cell").alias("parent")))
        depth += 1
    if not depth:
        return Tree(done[0], levels[0], depth, count)
    # one table each, in place of one for each depth
    whole = [cut_lineage(reduce(DataFrame.unionByName, parts).repartition("cell")) for parts in (done, levels)]
    return Tree(*whole, depth, count)


def meet(visits: DataFrame, points: DataFrame, task_rows: int = LEAF) -> tuple[DataFrame, DataFrame]:
    """Both sides dealt to tasks: the visits of one cell in parts of about ``task_rows``, the cell's points to each of the parts."""
    parts = cut_lineage(visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / task_rows).cast("int").alias("parts")))
    cells = small(parts, parts.count())
    part = F.pmod(F.xxhash64(*visits.columns), F.col("parts").cast("long")).cast("int").alias("part")
    each = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    return visits.join(cells, "cell").select(*visits.columns, part), points.join(cells, "cell").select(*points.columns, each)
