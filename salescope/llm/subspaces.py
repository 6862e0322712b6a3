"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors at cosine c or more are at squared distance 2 - 2c or less. After a fixed random rotation the dimensions are cut into
blocks, and each block gets its share of that budget in proportion to its dimensions. Within the whole budget, a pair is within the
share of at least one block; so each block is range-joined under its own share, and every pair found is verified by its cosine in
double precision. A pair counts only in the first block whose share it keeps, so no pair is counted twice and none is passed on.

The distinct vectors are stored once, dealt to chunks of bounded size by a hash. Each pair of chunks is a tile; a task reads the chunks of
its tiles from storage, so that what is stored and shuffled grows with the vectors, while the tiles grow with the square of their
number. In a tile the range join of a block lays a grid over its two leading coordinates: strips of the radius along the first, in the
order of the second inside. Rows are compared with those in their own and the neighbouring strips that are within the radius along the
second. Tasks return a count for each vector and a star for each component.

Equal vectors are compared once and counted with their number. Vectors that are null, empty, zero or hold null or non-finite numbers
link with nothing, nor do vectors of different lengths. Rows with null ids count and link like others. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from salescope.llm.common import stored
from salescope.llm.components import components, forest
from salescope.llm.scans import for_part
from salescope.session import scratch_path

BLOCK_DIMENSIONS, PAIRS, STEP = 8, 50_000, 256
#: Rows of a chunk, at most and at least, and the numbers in them.
CHUNK_ROWS, LEAST_ROWS, CHUNK_VALUES = 8192, 512, 1 << 21
#: Tiles that a task goes through, at most, and rows of results that it merges at a time.
TASK_TILES, MERGED_ROWS = 64, 1 << 18


@lru_cache(maxsize=8)
def rotation(dimensions: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(7).standard_normal((dimensions, dimensions)))[0]


def block_starts(dimensions: int) -> list[int]:
    return list(range(0, dimensions, BLOCK_DIMENSIONS))


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)  # so that no square overflows or vanishes
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _budgets(dimensions: int, cosine: float) -> np.ndarray:
    sizes = np.diff([*block_starts(dimensions), dimensions])
    return (2 - 2 * cosine) * sizes / dimensions * (1 + 1e-9) + 1e-12


class _Grid:
    """The rows of a chunk on the grid of one block. ``a`` and ``b`` hold the factors of squared distances, in single precision."""

    def __init__(self, part: np.ndarray, radius: float):
        second = part[:, min(1, part.shape[1] - 1)]
        strip = np.floor(part[:, 0] / radius).astype(np.int64)
        self.order = np.lexsort((second, strip))
        self.second = second[self.order]
        self.names, begins = np.unique(strip[self.order], return_index=True)
        self.begins, self.ends = begins, np.append(begins[1:], len(part))
        single = part[self.order].astype(np.float32)
        square, one = (single**2).sum(1, keepdims=True), np.ones((len(part), 1), np.float32)
        self.a, self.b = np.hstack([single, square, one]), np.hstack([-2 * single, one, square])

    def near(self, name: int, low: float, high: float) -> Iterator[tuple[int, int]]:
        """Stretches of places in the strips that meet this one, where the second coordinate is in the range."""
        first, last = np.searchsorted(self.names, [name - 1, name + 2])
        for begin, end in zip(self.begins[first:last], self.ends[first:last]):
            at, to = begin + np.searchsorted(self.second[begin:end], low), begin + np.searchsorted(self.second[begin:end], high, "right")
            if at < to:
                yield int(at), int(to)


class _Side:
    """Vectors of one length in a chunk."""

    def __init__(self, rows: pd.DataFrame, dimensions: int, kind: str, cosine: float):
        self.vid, self.copies = rows["vid"].to_numpy(), rows["copies"].to_numpy()
        self.units = _unit(np.frombuffer(b"".join(rows["vector"]), kind).astype("<f8").reshape(-1, dimensions))
        self.turned, self.budgets = self.units @ rotation(dimensions), _budgets(dimensions, cosine)
        self.starts = block_starts(dimensions)
        self.radii = np.sqrt(self.budgets) * (1 + 1e-6)
        self.grids = [_Grid(self.turned[:, s : s + BLOCK_DIMENSIONS], r) for s, r in zip(self.starts, self.radii)]


def _links(left: _Side, right: _Side, block: int, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified pairs of a tile that are due in this block; those of a chunk with itself once."""
    grid, other, radius, budget = left.grids[block], right.grids[block], left.radii[block], np.float32(left.budgets[block] + 1e-5)
    found, held = [], 0

    def verified() -> tuple[np.ndarray, np.ndarray]:
        x, y = (np.concatenate(side) for side in zip(*found))
        due = (np.add.reduceat((left.turned[x] - right.turned[y]) ** 2, left.starts, axis=1) <= left.budgets).argmax(1) == block
        x, y = x[due], y[due]
        linked = np.einsum("ij,ij->i", left.units[x], right.units[y]) >= cosine
        return x[linked], y[linked]

    for name, begin, end in zip(grid.names, grid.begins, grid.ends):
        for at in range(begin, end, STEP):
            to = min(at + STEP, end)
            for low, high in other.near(name, grid.second[at] - radius, grid.second[to - 1] + radius):
                # single precision gets some slack
                places = np.flatnonzero(grid.a[at:to] @ other.b[low:high].T <= budget)
                a, b = grid.order[at + places // (high - low)], other.order[low + places % (high - low)]
                if left is right:
                    a, b = a[a < b], b[a < b]
                for cut in range(0, len(a), PAIRS):
                    found.append((a[cut : cut + PAIRS], b[cut : cut + PAIRS]))
                    held += len(found[-1][0])
                    if held >= PAIRS:
                        yield verified()
                        found, held = [], 0
    if held:
        yield verified()


def _merged(parts: list[pd.DataFrame]) -> pd.DataFrame:
    """Counts added up by vector, and stars of the components of all parts' stars."""
    whole = pd.concat(parts, ignore_index=True)
    stars = whole["root"] >= 0
    counts = whole[~stars].groupby("vid", as_index=False)["n"].sum()
    node, root = forest(whole["vid"][stars].to_numpy(), whole["root"][stars].to_numpy())
    return pd.DataFrame({"vid": np.concatenate([counts["vid"], node]), "n": np.concatenate([counts["n"], np.zeros(len(node), np.int64)]),
                         "root": np.concatenate([np.full(len(counts), -1), root])}, dtype=np.int64)


def near_vectors(rows: DataFrame, cosine: float) -> DataFrame:
    """vec_id, n_links, component_id (null where no id is known), kept from ``vec_id, embedding``."""
    spark = rows.sparkSession
    of = rows.schema["vec_id"].dataType.simpleString()
    floats = isinstance(rows.schema["embedding"].dataType.elementType, FloatType)
    kind, size = ("<f4", 4) if floats else ("<f8", 8)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors = []
            for v in batch["embedding"]:
                if not (isinstance(v, np.ndarray) and v.dtype.kind == "f"):
                    v = [] if v is None else [np.nan if x is None else x for x in v]
                v = np.asarray(v, kind)
                vectors.append((v + v.dtype.type(0)).tobytes() if len(v) and np.isfinite(v).all() and v.any() else None)  # -0.0 becomes 0.0
            yield pd.DataFrame({"vec_id": batch["vec_id"], "vector": vectors})

    read_rows = rows.select("vec_id", "embedding").mapInPandas(read, f"vec_id {of}, vector binary").withColumn("key", F.unhex(F.md5("vector")))
    marked = stored(read_rows.select("vec_id", "key", (F.octet_length("vector") / size).cast("int").alias("width")), "vectors")
    n, width = marked.agg(F.approx_count_distinct("key", 0.02), F.coalesce(F.max("width"), F.lit(1))).first()
    across = math.ceil(math.sqrt(4 * spark.sparkContext.defaultParallelism))  # chunks that make some tiles for each core
    chunk = max(1, min(CHUNK_ROWS, CHUNK_VALUES // width, max(LEAST_ROWS, -(-n // across))))
    chunks = max(1, -(-n // chunk))
    distinct = read_rows.where("vector is not null").groupBy("key", "vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    folder = scratch_path(spark, "distinct-vectors")
    dealt = distinct.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(chunks)).cast("int")).repartition("part")
    dealt = dealt.withColumn("vid", F.monotonically_increasing_id()).select("key", "vector", "copies", "least", "vid", "part")
    dealt.write.partitionBy("part").parquet(folder)
    distinct = spark.read.schema(dealt.schema).parquet(folder)

    def tile(one: list[_Side], two: list[_Side]) -> list[pd.DataFrame]:
        out = []
        for left in one:
            for right in (x for x in two if len(x.starts) == len(left.starts) and x.units.shape[1] == left.units.shape[1]):
                counts, stars = (np.zeros(len(left.vid), np.int64), np.zeros(len(right.vid), np.int64)), []
                for block in range(len(left.starts)):
                    for x, y in _links(left, right, block, cosine):
                        np.add.at(counts[0], x, right.copies[y])
                        np.add.at(counts[1], y, left.copies[x])
                        stars.append(forest(left.vid[x], right.vid[y]))
                for side, count in zip((left, right), counts):
                    some = np.flatnonzero(count)
                    out.append(pd.DataFrame({"vid": side.vid[some], "n": count[some], "root": -1}))
                out += [pd.DataFrame({"vid": node, "n": 0, "root": root}) for node, root in stars]
        return out

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[_Side]] = {}
        waiting, total = [], 0

        def sides(part: int, beside: int) -> list[_Side]:
            if part not in held:
                for other in [x for x in held if x != beside]:
                    del held[other]
                found = for_part(folder, part, ["vector", "copies", "vid"])
                lengths = found["vector"].map(len) if len(found) else []
                held[part] = [_Side(own, length // size, kind, cosine) for length, own in found.groupby(lengths)] if len(found) else []
            return held[part]

        for batch in batches:
            for number in batch["id"]:
                i = (math.isqrt(8 * number + 1) - 1) // 2
                j = number - i * (i + 1) // 2
                one = sides(i, j)
                parts = tile(one, one if i == j else sides(j, i))
                waiting, total = waiting + parts, total + sum(map(len, parts))
                if total > MERGED_ROWS:
                    yield _merged(waiting)
                    waiting, total = [], 0
        if total:
            yield _merged(waiting)

    tiles = chunks * (chunks + 1) // 2
    tasks = min(tiles, max(16 * spark.sparkContext.defaultParallelism, -(-tiles // TASK_TILES)))
    found = stored(spark.range(0, tiles, 1, tasks).mapInPandas(compare, "vid long, n long, root long"), "vector-links")
    counts = found.where("root = -1").groupBy("vid").agg(F.sum("n").alias("n"))
    roots = components(found.where("root >= 0").select(F.col("vid").alias("a"), F.col("root").alias("b")))
    named = distinct.join(counts, "vid", "left").join(roots.withColumnRenamed("node", "vid"), "vid", "left").select(
        "key", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "vid").alias("root"))
    named = stored(named, "named-vectors")
    groups = named.groupBy("root").agg(F.min("least").alias("component_id"))
    out = marked.join(named.join(groups, "root").select("key", "n_links", "component_id"), "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).cast("long")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
