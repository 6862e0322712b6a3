"""Answers from all blocks of documents for the 64-bit keys of each block.

Documents are dealt to blocks of a few MB by a hash of their row, so that no source or id makes a block larger than others. A block
sends its distinct keys, sorted, to buckets; equal keys of one block travel once, so that a key that a third of all rows hold meets
in a bucket once for each block. A bucket answers each block with one number for each key it sent, in the order it sent them; the
block can form the same keys again, and so needs no keys in return. All blobs are plain little-endian arrays.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import stored

BLOCK_BYTES = 4 << 20
BUCKET_KEYS = 600_000


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """``doc_id, text, block`` and the size of all texts. Rows of one id spread by their texts, and equal rows by where they are stored."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    count = max(1, -(-total // block_bytes))
    placed = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_place"))
    block = F.pmod(F.xxhash64("doc_id", "text", "_place", F.lit(count)), F.lit(count)).cast("int")
    return stored(placed.withColumn("block", block).drop("_place"), "blocks", "zstd"), total


def buckets_for(total_keys: int) -> int:
    """A power of two, so that a bucket has some 600,000 keys before equal ones are merged."""
    return 1 << max(0, int(total_keys // BUCKET_KEYS).bit_length())


class Sent:
    """A block's distinct keys: ``parts`` are (bucket, an index into the block's keys for each distinct one)."""

    def __init__(self, order: np.ndarray, places: np.ndarray, parts: list[tuple[int, np.ndarray]], n: int):
        self.order, self.places, self.parts, self.n = order, places, parts, n

    def counts(self) -> np.ndarray:
        """How often each distinct key occurs in the block."""
        return np.diff(np.append(self.places, self.n))

    def spread(self, answers: np.ndarray) -> np.ndarray:
        """One answer for each distinct key, given back to every occurrence."""
        out = np.empty(self.n, answers.dtype)
        out[self.order] = np.repeat(answers, self.counts())
        return out


def sent(keys: np.ndarray, spread: np.ndarray, buckets: int) -> Sent:
    """Distinct (bucket, key), sorted. Buckets come from bits that are independent of the key, which lengthen it as the input grows."""
    bucket = (spread & np.uint64(buckets - 1)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    order = np.argsort(keys)
    order = order[np.argsort(bucket[order], kind="stable")]
    k, b = keys[order], bucket[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (b[1:] != b[:-1])
    places = np.flatnonzero(new)
    cuts = np.flatnonzero(np.diff(b[places].astype(np.int64))) + 1
    return Sent(order, places, [(int(b[p[0]]), order[p]) for p in np.split(places, cuts) if len(p)], len(keys))


def bucketed(messages: DataFrame, merge: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``merge`` on all messages of one bucket."""
    return messages.groupBy("bucket").applyInPandas(merge, schema)
