"""Merkle manifest of a dataset, level by level with lag and lead windows.

Each row is a leaf. The leaves of a group, in the order of their key, form a tree: every ``fanout`` consecutive nodes (the last run may
be shorter, and one alone still counts) become the digest of their digests, until one is left. The groups' nodes, in the order of the
group's name, form one more tree in the same way.

A leaf's place in its group comes from a range sort over all rows, so that a group of any size is spread. Windows then run over blocks
of ``fanout ** m`` (at most ``BLOCK``) consecutive places. A node lies in the row of its first leaf: at level l only rows whose place is
a multiple of ``fanout ** l`` hold one, and a node's siblings are found ``fanout ** l``, twice that, .. rows before and after it, as
its slot in the run allows and as far as rows go. The row of a run's first child digests the run. After m levels each row is given,
by a running last value, the siblings of all its ancestors in the block. The blocks' own nodes are the leaves of the next storey, and
a row's further siblings come from the row of its block there, by an equal join on group and block.

Nulls: a field that is null counts as ``-``; a null group is a group of its own, before all others; null keys come first. Rows of one
key are ordered by their leaf, so repeated rows, whose leaves are equal, give one tree in any order. A text of any length is digested
whole. No rows give no rows. Columns that are neither key, group nor field are not read, and field names are free.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.common import stored

BLOCK = 1024
SIDES = "array<struct<before:string,after:string>>"


def digest(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts), 256)


def field(value: Column) -> Column:
    """A value with its size in bytes before it, or ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def placed(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` with ``place``, from 0 in the order of ``order`` within ``grp``, and the group's size ``n``.

    Rows are sorted by range with a fixed number as the last key, so equal rows spread too. What meets for each group is one row for
    each range that holds a part of it.
    """
    fixed = stored(nodes.withColumn("spread", F.xxhash64(F.monotonically_increasing_id())), "merkle-nodes")
    keys = ["grp", *order, "spread"]
    ranged = fixed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = stored(ranged.withColumn("id", F.monotonically_increasing_id()).withColumn("part", F.shiftright("id", 33)), "merkle-order")
    parts = rows.groupBy("part", "grp").agg(F.min("id").alias("first"), F.count("*").alias("rows"))
    group = Window.partitionBy("grp").orderBy("part")
    offsets = parts.select(
        F.col("part").alias("o_part"), F.col("grp").alias("o_grp"), "first",
        F.coalesce(F.sum("rows").over(group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
        F.sum("rows").over(Window.partitionBy("grp")).alias("n"))
    joined = rows.join(offsets, (F.col("part") == F.col("o_part")) & F.col("grp").eqNullSafe(F.col("o_grp")))
    return joined.select(*nodes.columns, (F.col("start") + F.col("id") - F.col("first")).alias("place"), "n")


def storey(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``nodes`` (grp, place, n, node, ..) with ``block``, ``path`` (siblings in the block, level by level) and ``top`` (the block's node, in its first row)."""
    size = fanout**levels
    rows = nodes.withColumn("block", F.floor(F.col("place") / size)).withColumn("at", F.col("node"))
    order = Window.partitionBy("grp", "block").orderBy("place")
    for level in range(levels):
        step = fanout**level
        slot = F.floor(F.col("place") / step) % fanout
        holds = (F.col("place") % step == 0) & (F.col("n") > step)
        before = [F.when(slot >= j, F.lag("at", j * step).over(order)) for j in range(fanout - 1, 0, -1)]
        after = [F.when(slot + j < fanout, F.lead("at", j * step).over(order)) for j in range(1, fanout)]
        rows = rows.withColumns({"before": F.concat_ws("", *before), "after": F.concat_ws("", *after)})
        rows = rows.withColumns({
            f"side{level}": F.when(holds, F.struct("before", "after")),
            "at": F.when(holds & (slot == 0), digest(F.col("at"), F.col("after"))).when(~holds, F.col("at"))})
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sides = [F.last(f"side{level}", ignorenulls=True).over(upto) for level in range(levels)]
    path = F.filter(F.array(*sides), lambda s: s.isNotNull()).cast(SIDES)
    return rows.select(*nodes.columns, "block", path.alias("path"), F.when(F.col("place") % size == 0, F.col("at")).alias("top"))


def trees(nodes: DataFrame, order: Sequence[str], fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The storeys of each group's tree from the leaves up, and ``grp, node``: each group's last node."""
    levels = 1
    while fanout ** (levels + 1) <= BLOCK:
        levels += 1
    rows = placed(nodes, order)
    largest = rows.agg(F.max("n").alias("n")).first()["n"] or 0
    storeys = []
    while not storeys or largest > 1:
        done = stored(storey(rows, fanout, levels), "merkle-storey")
        storeys.append(done)
        largest = -(-largest // fanout**levels)
        up = (F.col("n") + F.lit(fanout**levels - 1)) / F.lit(fanout**levels)
        rows = done.where("top is not null").select("grp", F.col("block").alias("place"), F.floor(up).alias("n"), F.col("top").alias("node"))
    return storeys, rows.select("grp", "node")


def with_paths(storeys: list[DataFrame], above: DataFrame) -> DataFrame:
    """The leaves with whole paths; ``above`` has ``grp``, the rest of the path and columns of the group."""
    extra = [c for c in above.columns if c not in ("grp", "path")]
    upper = above.select(F.col("grp").alias("u_grp"), F.lit(0).cast("long").alias("u_block"), F.col("path").alias("u_path"), *extra)
    for rows in reversed(storeys):
        joined = rows.join(upper, (F.col("block") == F.col("u_block")) & F.col("grp").eqNullSafe(F.col("u_grp")))
        joined = joined.withColumn("path", F.concat("path", "u_path")).drop("u_grp", "u_block", "u_path", "top")
        upper = joined.select(F.col("grp").alias("u_grp"), F.col("place").alias("u_block"), F.col("path").alias("u_path"), *extra)
    return joined


def manifest(leaves: DataFrame, key: str, group: str, fanout: int = 2) -> DataFrame:
    """``leaves`` (key, group, ``leaf`` and other columns) with ``place``, ``subroot``, ``root`` and ``path``.

    ``path`` holds for each level up to the root the digests before and after the row's ancestor in its run, put together.
    """
    rest = F.struct(*[F.col(c) for c in leaves.columns]).alias("row")
    nodes = leaves.select(F.col(group).alias("grp"), F.col(key).alias("key"), F.col("leaf").alias("node"), rest)
    storeys, subroots = trees(nodes, ["key", "node"], fanout)
    subroots = stored(subroots, "merkle-subroots")
    over, roots = trees(subroots.select(F.lit(0).alias("grp"), F.col("grp").alias("name"), "node"), ["name"], fanout)
    top = with_paths(over, roots.select("grp", F.col("node").alias("root"), F.array().cast(SIDES).alias("path")))
    above = top.select(F.col("name").alias("grp"), "path", F.col("node").alias("subroot"), "root")
    return with_paths(storeys, above).select("row.*", "place", "subroot", "root", "path")


def folded(node: Column, path: Column) -> Column:
    """The root that follows from a node and its siblings."""
    return F.aggregate(path, node, lambda at, side: F.sha2(F.concat(side["before"], at, side["after"]), 256))


def proof(path: Column) -> Column:
    """Digest of all siblings of a path."""
    return F.sha2(F.array_join(F.transform(path, lambda side: F.concat(side["before"], side["after"])), ""), 256)
