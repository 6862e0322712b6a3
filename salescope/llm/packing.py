"""Packing of pieces into sequences of a fixed capacity by linear grouping.

Only counts of lengths reach the driver, and there are at most ``capacity`` lengths. There the plan is made:

1. Lengths over ``small`` are dealt, in order, into ``groups`` groups of equal cardinality; each length is rounded up to the
   greatest of its group.
2. Configurations (how many pieces of each rounded size share a sequence) are chosen by column generation on the linear programme
   of the few sizes; its solution is rounded down and the rest is placed by best fit.
3. Actual pieces, in order of length, take the places of their group, which leaves at least the room that was planned.
4. Small pieces follow by best fit, longest first.

The plan consists of runs: as many consecutive sequences with one and the same list of lengths. A run is split only where a length
ends, so their number depends on the number of lengths and not on that of pieces. Pieces find their place by their rank among those
of equal length: a join with the plan's rows (length, ranks from, to). Ranks come from counts per block of rows, so that no length,
however common, meets in one task.

Lengths must lie in 1..capacity. Equal rows and null keys are placed like any other; no rows give no rows.
"""

from __future__ import annotations

import bisect
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.common import stored

GROUPS = 24
SMALL = 1 / 8


def _pattern(values: np.ndarray, sizes: list[int], capacity: int) -> np.ndarray:
    """The configuration of greatest value: an unbounded knapsack."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    sizes_, order = np.array(sizes), np.arange(len(sizes))
    for room in range(min(sizes), capacity + 1):
        fits = order[sizes_ <= room]
        gain = best[room - sizes_[fits]] + values[fits]
        k = int(gain.argmax())
        best[room], last[room] = (gain[k], fits[k]) if gain[k] > best[room - 1] + 1e-12 else (best[room - 1], -1)
    out, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            out[last[room]] += 1
            room -= sizes[last[room]]
    return out


def configurations(sizes: list[int], counts: list[int], capacity: int, rounds: int = 400) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to use each: the linear programme's solution, rounded down."""
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(counts, float)
    use = np.linalg.solve(basis, need)
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        column = _pattern(np.maximum(prices, 0), sizes, capacity)
        if prices @ column <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, column)
        ratio = np.where(step > 1e-12, use / np.where(step > 1e-12, step, 1), np.inf)
        leave = int(ratio.argmin())
        basis[:, leave] = column
        use = np.maximum(np.linalg.solve(basis, need), 0)
    return [(basis[:, j].astype(int), int(use[j] + 1e-9)) for j in range(len(sizes))]


class _Runs:
    """Runs of equal sequences by the room that is left in them: [room][(first sequence, how many, filled)]."""

    def __init__(self, capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.rooms: list[int] = []
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.placed: list[tuple[int, int, int, int, int]] = []  # length, rank from, rank to, first sequence, offset

    def add(self, room: int, first: int, n: int) -> None:
        if n and room:
            if room not in self.open:
                bisect.insort(self.rooms, room)
            self.open[room].append((first, n))

    def new(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def best_fit(self, length: int, rank: int, count: int) -> None:
        """Each sequence of a run gets as many as it holds, the run with the least room first."""
        while count:
            at = bisect.bisect_left(self.rooms, length)
            if at == len(self.rooms):
                each = self.capacity // length
                full = max(1, count // each) if count >= each else 1
                self.add(self.capacity, self.new(full), full)
                continue
            room = self.rooms[at]
            first, n = self.open[room].pop()
            if not self.open[room]:
                del self.open[room]
                self.rooms.pop(at)
            take = min(n, count)
            self.placed.append((length, rank, rank + take, first, self.capacity - room))
            rank, count = rank + take, count - take
            self.add(room - length, first, take)
            self.add(room, first + take, n - take)


def plan(lengths: dict[int, int], capacity: int, groups: int = GROUPS, small: float = SMALL) -> tuple[list[tuple], int]:
    """Places for ``lengths`` (length: count): rows (length, rank from, rank to, first sequence, offset), and how many sequences."""
    runs = _Runs(capacity)
    large = sorted((n, c) for n, c in lengths.items() if n > capacity * small)
    total = sum(c for _, c in large)
    if total:
        edges = sorted({-(-total * g // groups) for g in range(1, groups + 1)})
        stock: list[list[list[int]]] = []  # for each group: [length, rank from, count], longest last
        sizes, counts, passed, g = [], [], 0, 0
        for length, count in large:
            rank = 0
            while count:
                if len(stock) == g:
                    stock.append([])
                    sizes.append(0)
                    counts.append(0)
                take = min(count, edges[g] - passed)
                stock[g].append([length, rank, take])
                sizes[g], counts[g] = length, counts[g] + take
                passed, rank, count = passed + take, rank + take, count - take
                g += passed == edges[g]
        merged = Counter()
        for size, count in zip(sizes, counts):
            merged[size] += count
        few = sorted(merged)
        pools = {s: [x for z, pool in zip(sizes, stock) if z == s for x in pool] for s in few}
        for pattern, times in configurations(few, [merged[s] for s in few], capacity):
            slots = [s for s, k in zip(few, pattern) for _ in range(k)][::-1]
            open_runs = [(runs.new(times), times, 0)] if times else []
            for size in slots:
                following = []
                for first, n, filled in open_runs:
                    while n and pools[size]:
                        length, rank, left = pools[size][-1]
                        take = min(n, left)
                        runs.placed.append((length, rank, rank + take, first, filled))
                        following.append((first, take, filled + length))
                        pools[size][-1] = [length, rank + take, left - take]
                        if take == left:
                            pools[size].pop()
                        first, n = first + take, n - take
                    if n:
                        following.append((first, n, filled))
                open_runs = following
            for first, n, filled in open_runs:
                runs.add(capacity - filled, first, n)
        for size in reversed(few):
            for length, rank, count in reversed(pools[size]):
                runs.best_fit(length, rank, count)
    for length, count in sorted(lengths.items(), reverse=True):
        if length <= capacity * small:
            runs.best_fit(length, 0, count)
    return runs.placed, runs.sequences


def pack(pieces: DataFrame, length: str, capacity: int, order: list[str]) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``order`` settles which of equally long pieces comes first."""
    spark = pieces.sparkSession
    fixed = stored(pieces.withColumn("_block", F.spark_partition_id()), "pieces")
    counts = stored(fixed.groupBy(F.col(length).alias("_length"), "_block").agg(F.count("*").alias("_n")), "counts")
    totals = {r["_length"]: r["n"] for r in counts.groupBy("_length").agg(F.sum("_n").alias("n")).collect()}
    if any(n is None or not 1 <= n <= capacity for n in totals):
        raise ValueError(f"a length is not in 1..{capacity}")
    placed, _ = plan(totals, capacity)
    layout = "_length long, _from long, _to long, _first long, _offset long"
    slots = spark.createDataFrame([tuple(map(int, row)) for row in placed], layout)
    before = Window.partitionBy("_length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # a block's rows of a length are counted in slot order, so its stretch of ranks meets few slots
    parts = counts.join(slots, "_length").where("_from < _base + _n and _to > _base").select(
        F.col("_block"), F.col("_length"), F.struct(F.col("_from"), "_to", "_first", "_offset", "_base").alias("_slot"))
    parts = parts.groupBy("_block", "_length").agg(F.array_sort(F.collect_list("_slot")).alias("_slots"))
    within = Window.partitionBy("_block", length).orderBy(*order)
    ranked = fixed.withColumn("_rank", F.row_number().over(within) - 1)
    joined = ranked.join(parts.withColumnRenamed("_length", length), ["_block", length], "left")
    rank = F.col("_rank") + F.col("_slots")[0]["_base"]
    slot = F.filter("_slots", lambda s: (s["_from"] <= rank) & (rank < s["_to"]))[0]
    out = joined.withColumn("_place", slot)
    return out.select(*[c for c in pieces.columns],
                      (F.col("_place._first") + rank - F.col("_place._from")).alias("sequence_id"), F.col("_place._offset").alias("offset"))
