"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import stored


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links a-b of one task as a star to the least node of each component."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = places[: len(a)], places[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    away = label != np.arange(len(nodes))
    return nodes[away], nodes[label[away]]


def components(links: DataFrame, rounds_limit: int = 200) -> DataFrame:
    """``node, root`` for every node of ``links`` (two long columns ``a``, ``b``) that is not its component's least node.

    Least neighbours are aggregates, which combine before the shuffle; they are joined back to the links, where adaptive execution
    splits the links of a node that has very many. Each round is written to the shared folder.
    """
    pairs = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    for _ in range(rounds_limit):
        both = pairs.union(pairs.select("b", "a").toDF("a", "b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(least.select("a", "m").toDF("a", "b"))
        pairs = stored(small.distinct(), "links")
        now = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == state:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
    raise RuntimeError("components did not settle")
