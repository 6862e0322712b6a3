"""Running totals, ranks, quantiles and row numbers over a whole table.

A window without partition keys sends every row to one task. Here an order is cut into ranges instead, which Spark samples from the
data, so a crowded stretch of values is cut as well as any other; each range is summed on its own, and only the ranges' totals (one row
for each sort partition) meet in one place. Quantiles need no order at all: counts of value buckets show which buckets hold the ranks
asked for, these are split again until few values are left in them, and only those values are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from salescope.session import cut_lineage

STEPS_PER_DOUBLING = 64


def value_bucket(value: Column) -> Column:
    """Monotone integer bucket of a number; a double has at most 2 * 64 * 1024 of them, plus null and NaN."""
    x = value.cast("double")
    size = F.floor(F.log2(F.lit(1.0) + F.abs(x)) * STEPS_PER_DOUBLING)
    return (
        F.when(x.isNull(), F.lit(-(1 << 62)))
        .when(F.isnan(x), F.lit(1 << 62))
        .when(x < 0, -size)
        .otherwise(size)
        .cast("long")
    )


def sorted_ranges(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` sorted by range and fixed in storage, with ``_range`` (the sort partition) and ``_at`` (from 0 in it)."""
    fixed = cut_lineage(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    return fixed.select(*df.columns, F.shiftright("_id", 33).alias("_range"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"))


def before_ranges(ranged: DataFrame, sums: Sequence[str] = ()) -> DataFrame:
    """Rows and sums of all earlier ranges, one row for each range."""
    totals = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_sum_{c}") for c in sums])
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    return totals.select(
        "_range",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in sums],
    )


def running(
    df: DataFrame,
    by: str,
    sums: Sequence[str] = (),
    descending: bool = False,
    tie: Sequence[str] = (),
    position: str = "position",
) -> DataFrame:
    """Add the 1-based ``position`` and ``running_<c>`` for each of ``sums`` in the order of ``by``.

    ``tie`` makes the order total. Without it rows of one value are spread by a number fixed before the sort, in any order.
    """
    value_order = F.col(by).desc() if descending else F.col(by).asc()
    if tie:
        ranged = sorted_ranges(df, [value_order, *[F.col(c) for c in tie]])
    else:
        spread = cut_lineage(df.withColumn("_spread", F.xxhash64(F.monotonically_increasing_id())))
        ranged = sorted_ranges(spread, [value_order, F.col("_spread")])
    upto = W.partitionBy("_range").orderBy("_at").rowsBetween(W.unboundedPreceding, W.currentRow)
    # one row for each sort partition
    joined = ranged.join(F.broadcast(before_ranges(ranged, sums)), "_range")
    return joined.select(
        *df.columns,
        (F.col("_before") + F.col("_at") + 1).alias(position),
        *[(F.col(f"_before_{c}") + F.sum(c).over(upto)).alias(f"running_{c}") for c in sums],
    )


#: A bucket of fewer values is ordered, a larger one split into so many pieces.
ENOUGH, PIECES = 1 << 16, 1 << 10
#: Intervals of at most so many keys are broadcast; of more, the values are joined to them by key.
FEW_KEYS = 1 << 16


def _holding(buckets: DataFrame, group: Sequence[str], kept: Sequence[str]) -> DataFrame:
    """Those ``buckets`` (``group``, b, n, lo, hi, ``kept``, ws) that hold a rank, with ranks counted from their start.

    ``ws`` are the ranks asked for in the group; it holds a few for each probability, so the explosion is bounded.
    """
    upto = W.partitionBy(*group).orderBy("b").rowsBetween(W.unboundedPreceding, -1)
    placed = buckets.withColumn("start", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    inside = F.filter("ws", lambda w: (w["rank"] >= F.col("start")) & (w["rank"] < F.col("start") + F.col("n")))
    moved = F.transform(inside, lambda w: F.struct(w["i"].alias("i"), w["side"].alias("side"), (w["rank"] - F.col("start")).alias("rank")))
    return placed.where(F.size(inside) > 0).select(*kept, "n", "lo", "hi", moved.alias("ws"))


def _in_intervals(values: DataFrame, hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``values`` that lie in one of their key's intervals, with its ends ``lo`` and ``hi``."""
    if keys:
        per_key = cut_lineage(hits.groupBy(*keys).agg(F.collect_list(F.struct("lo", "hi")).alias("_in")))
        few = per_key.count() <= FEW_KEYS
        found = values.join(F.broadcast(per_key) if few else per_key, list(keys))
    else:  # at most two intervals for each probability
        ends = [F.struct(F.lit(h["lo"]).alias("lo"), F.lit(h["hi"]).alias("hi")) for h in hits.select("lo", "hi").collect()]
        found = values.withColumn("_in", F.array(*ends) if ends else F.array().cast("array<struct<lo:double,hi:double>>"))
    own = F.get(F.filter("_in", lambda s: F.col("v").between(s["lo"], s["hi"])), F.lit(0))
    return found.withColumn("_own", own).where(F.col("_own").isNotNull()).select(*keys, "v", "_own.lo", "_own.hi")


def quantiles(df: DataFrame, column: str, probabilities: Sequence[float], name: str = "q",
              keys: Sequence[str] = ()) -> DataFrame:
    """Array of exact, linearly interpolated quantiles of a numeric column, one row (per ``keys``).

    Each pass counts values by bucket (combined before the shuffle) and keeps the buckets that hold a rank asked for. One of more
    than ``ENOUGH`` values is cut between its least and its greatest value into ``PIECES`` in the next pass, which always leaves fewer.
    """
    ps = [float(p) for p in probabilities]
    keys = list(keys)
    values = df.where(F.col(column).isNotNull()).select(*keys, F.col(column).cast("double").alias("v"))
    sizes = [F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")]
    buckets = values.groupBy(*keys, value_bucket(F.col("v")).alias("b")).agg(*sizes)
    buckets = buckets.withColumn("total", F.sum("n").over(W.partitionBy(*keys)))
    places = [(i, side, f((F.col("total") - 1) * F.lit(p))) for i, p in enumerate(ps) for side, f in (("lo", F.floor), ("hi", F.ceil))]
    asked = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), rank.cast("long").alias("rank")) for i, side, rank in places])
    kept = [*keys, "total"]
    hits = cut_lineage(_holding(buckets.withColumn("ws", asked), keys, kept))
    interval = [*keys, "lo", "hi"]
    while True:
        large = (F.col("n") > ENOUGH) & (F.col("lo") < F.col("hi"))
        wide = hits.where(large)
        if wide.isEmpty():
            break
        piece = F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * PIECES).alias("b")
        pieces = _in_intervals(values, wide, keys).groupBy(*interval, piece).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("first"), F.max("v").alias("last"))
        asked_there = wide.select(*interval, "total", "ws")
        finer = _holding(pieces.join(asked_there, interval).select(
            *keys, F.struct("lo", "hi").alias("of"), "total", "ws", "b", "n", F.col("first").alias("lo"), F.col("last").alias("hi")),
            [*keys, "of"], kept)
        hits = cut_lineage(hits.where(~large).unionByName(finer))
    alike = hits.where(~(F.col("lo") < F.col("hi"))).select(*kept, F.col("lo").alias("v"), F.inline("ws"))
    few = hits.where(F.col("lo") < F.col("hi"))
    counts = _in_intervals(values, few, keys).groupBy(*interval, "v").agg(F.count(F.lit(1)).alias("n"))
    upto = W.partitionBy(*interval).orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow)
    ordered = counts.withColumn("end", F.sum("n").over(upto)).withColumnRenamed("n", "same")
    picked = ordered.join(few.select(*interval, "total", "ws"), interval).select(*kept, "v", "same", "end", F.inline("ws"))
    picked = picked.where((F.col("rank") >= F.col("end") - F.col("same")) & (F.col("rank") < F.col("end")))
    picked = picked.select(*kept, "v", "i", "side", "rank").unionByName(alike)

    def at(i: int, side: str) -> Column:
        return F.max(F.when((F.col("i") == i) & (F.col("side") == side), F.col("v")))

    def interpolate(i: int, p: float) -> Column:
        lo, hi = at(i, "lo"), at(i, "hi")
        place = (F.max("total") - 1) * F.lit(p)
        return F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (place - F.floor(place)))

    return picked.groupBy(*keys).agg(F.array(*[interpolate(i, p) for i, p in enumerate(ps)]).alias(name))


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the exact median of each column, all from the same passes."""
    tall = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in columns])))
    found = quantiles(tall, "v", [0.5], keys=["name"])
    return found.agg(*[F.max(F.when(F.col("name") == c, F.col("q")[0])).alias(c) for c in columns])


def number_rows(df: DataFrame, order: Sequence[Column], position: str = "position") -> DataFrame:
    """Exact 0-based row number under any sort order, for tables of any size."""
    ranged = sorted_ranges(df, order)
    return ranged.join(F.broadcast(before_ranges(ranged)), "_range").select(*df.columns, (F.col("_before") + F.col("_at")).alias(position))


def first_row(df: DataFrame, *order: Column, n: int = 1) -> DataFrame:
    """The first ``n`` rows of an order (a partial top-k per task, then one merge)."""
    return df.orderBy(*order).limit(n)


def one_row(df: DataFrame) -> Column:
    """A single-row frame as a struct-valued scalar subquery."""
    return df.select(F.struct(*[F.col(c) for c in df.columns]).alias("s")).scalar()
