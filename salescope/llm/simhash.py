"""SimHash near-duplicates with pivot distance tables.

Fingerprints are compared once each, however many documents have them. Fingerprints at ``radius`` differing bits or fewer share at
least ``blocks - radius`` of ``blocks`` stretches of bits, so they meet in the bucket of some choice of stretches. A bucket with more
than ``BUCKET`` fingerprints is split by one more of its remaining stretches (at least one is shared again), until it fits or too few
bits are left to hold more; so no bucket is unbounded and none is cut.

Inside buckets a table of Hamming distances to reference fingerprints decides: two fingerprints cannot be nearer than the greatest
difference of their distances to any reference. Rows are sorted by their distance to the first reference, compared while that stays
within the radius, discarded by the other references, and the survivors verified bit by bit. A task passes on only a star for each
component of what it found.

``near_duplicates`` with ``words`` over 1 also links at a share of bits that is too low for this: fingerprints of ``words`` times 64 bits
(the first 64 are the fingerprint above) that agree in a whole band of ``BAND`` bits meet, and link if ``agreement`` of all their bits
agree. At 320 bits there are 26 bands, and a pair whose shingles have a similarity of 0.8 shares none of them in about 2 of 100 cases.
Rows of one band are cut into chunks of at most about ``CHUNK`` rows, and each two chunks are compared on their own, so memory is bounded;
the work in a band's bucket grows with its square, but a crowd of near copies passes on about one link for each of its rows.

``similar_documents`` takes the bands as candidate search only: a pair becomes a link if the sets of its shingles have a Jaccard
similarity of at least ``similarity``, counted on the shingles themselves. Documents of one set are one node. In a tile, pairs that
share no earlier band, agree in ``agreement`` of their bits and are near enough in size are candidates; a tile passes on the nodes of
each connected group of them, and each group is settled on its texts. Chunks are also limited to about ``CHUNK_SHINGLES`` shingles, so
that a group fits in memory (a single text may be larger). A node already connected is not compared again, so a crowd of true near
copies takes about one pass over its shingles and a crowd of false ones a pass for each of its nodes.

Null, empty and blank texts have fingerprint zero and are linked like any other. Equal rows share a fingerprint. Null ids: a row is
kept, and a group without any id has a null component. No rows give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import stored
from salescope.llm.components import components, forest
from salescope.llm.ragged import mix

BLOCKS, REFERENCES, BUCKET, TASK_ROWS = 5, 16, 2048, 100_000
BAND, CHUNK = 12, 2048
CHUNK_SHINGLES, TASK_SHINGLES = 1_000_000, 1_000_000
BIT = np.uint64(1)


def _majority(hashes: np.ndarray) -> np.uint64:
    """Bits that are set in over half of the hashes."""
    tally = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        tally += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return ((tally * 2 > len(hashes)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64)


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of each run of ``shingle`` words; a shorter text is one run."""
    from xxhash import xxh64_intdigest

    found = text.encode().lower().split() if text else []  # bytes: only A-Z is lower-cased, only ASCII blanks split
    if not found:
        return np.zeros(0, np.uint64)
    line = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = max(len(found) - shingle + 1, 1)
    last = ends[shingle - 1 :] if len(found) >= shingle else ends[-1:]
    return np.fromiter((xxh64_intdigest(line[a:b], 42) for a, b in zip(starts[:n].tolist(), last.tolist())), np.uint64, n)


def _marks(hashes: np.ndarray, words: int) -> np.ndarray:
    if not len(hashes):
        return np.zeros(words, np.uint64)
    return np.array([_majority(hashes if j == 0 else mix(hashes + np.uint64(j))) for j in range(words)], np.uint64)


def fingerprint(text: str | None, shingle: int, words: int = 1) -> np.ndarray:
    """Bits set in over half of the shingles' XXH64 values, and of ``words`` - 1 further mixes of these."""
    return _marks(shingle_hashes(text, shingle), words)


def fingerprints(docs: DataFrame, shingle: int, words: int = 1) -> DataFrame:
    """doc_id, fp (long: the first 64 bits), wide (all bits)."""
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            marks = [fingerprint(t, shingle, words).astype("<u8") for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": [int(m.view("<i8")[0]) for m in marks], "wide": [m.tobytes() for m in marks]})

    return docs.select("doc_id", "text").mapInPandas(make, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long, wide binary")


def _stretches(bits: int, parts: int) -> list[int]:
    """Masks of ``parts`` stretches of the bits set in ``bits``."""
    places = [i for i in range(64) if bits >> i & 1]
    return [sum(1 << i for i in part.tolist()) for part in np.array_split(np.array(places), min(parts, len(places)))]


def _masks(radius: int, blocks: int) -> list[int]:
    parts = _stretches((1 << 64) - 1, blocks)
    return [sum(chosen) for chosen in combinations(parts, blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_links(fps: DataFrame, radius: int, blocks: int = BLOCKS) -> DataFrame:
    """Links ``a, b`` that connect all distinct fingerprints of column ``fp`` at ``radius`` differing bits or fewer."""
    masks = [_signed(m) for m in _masks(radius, blocks)]
    rows = fps.select("fp", F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask"))
    settled = None
    while True:
        rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        rows = stored(rows.join(sizes, ["mask", "key"]), "buckets")
        room = 64 - F.bit_count("mask")
        fits = rows.where((F.col("n") <= BUCKET) | (room <= 11))  # 11 bits are at most 2048 fingerprints
        settled = fits if settled is None else settled.union(fits)
        hot = rows.where((F.col("n") > BUCKET) & (room > 11))
        wide = [r["mask"] for r in hot.select("mask").distinct().collect()]  # choices of stretches, not data
        if not wide:
            break
        finer = F.create_map(*[x for m in wide for x in (F.lit(m), F.array(*[
            F.lit(_signed(m % (1 << 64) | part)) for part in _stretches(((1 << 64) - 1) ^ (m % (1 << 64)), radius + 1)]))])
        rows = hot.select("fp", F.explode(finer[F.col("mask")]).alias("mask"))
    rows = stored(settled, "settled")
    tasks = max(1, -(-rows.count() // TASK_ROWS))
    dealt = rows.withColumn("task", F.pmod(F.xxhash64("mask", "key"), F.lit(tasks)))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        fp = frame["fp"].to_numpy().view(np.uint64)
        bucket = pd.factorize(pd.MultiIndex.from_frame(frame[["mask", "key"]]))[0]
        pivots = mix(np.arange(1, REFERENCES + 1, dtype=np.uint64))
        table = np.bitwise_count(fp[:, None] ^ pivots[None, :]).astype(np.int8)
        order = np.lexsort((table[:, 0], bucket))
        fp, bucket, table = fp[order], bucket[order], table[order]
        a, b, live = [], [], np.arange(len(fp))
        for lag in range(1, len(fp)):
            live = live[live + lag < len(fp)]
            near = (bucket[live] == bucket[live + lag]) & (table[live + lag, 0] - table[live, 0] <= radius)
            live = live[near]  # rows further down are in another bucket or farther still
            if not len(live):
                break
            pair = live
            for j in range(1, REFERENCES):
                pair = pair[np.abs(table[pair, j] - table[pair + lag, j]) <= radius]
            pair = pair[np.bitwise_count(fp[pair] ^ fp[pair + lag]) <= radius]
            a.append(pair)
            b.append(pair + lag)
        if not a:
            return pd.DataFrame({"a": [], "b": []}, dtype=np.int64)
        x, y = forest(fp[np.concatenate(a)].view(np.int64), fp[np.concatenate(b)].view(np.int64))
        return pd.DataFrame({"a": x, "b": y})

    return dealt.groupBy("task").applyInPandas(compare, "a long, b long")


def _spanning(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the table connects (rows first, then columns are numbered): in a crowded table at most one each."""
    high, wide = near.shape
    if np.count_nonzero(near) <= high + wide:
        x, y = np.nonzero(near)
        return x, y + high
    label = np.arange(high, dtype=np.int16)
    while True:
        column = np.where(near, label[:, None], np.int16(high)).min(0)
        new = np.minimum(label, np.where(near, column[None, :], np.int16(high)).min(1))
        if (new == label).all():
            break
        label = new
    held = np.flatnonzero(column < high)
    return np.concatenate([np.arange(high), held + high]), np.concatenate([label, column[held]]).astype(np.int64)


def _tiles(rows: DataFrame, words: int, chunks: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` for each band of column ``wide`` (``bucket``) and each other chunk of the band's rows: tiles of chunks ``low``, ``high``.

    ``chunks`` gives from the placed rows ``bucket``, ``n`` (rows) and ``chunks`` of each bucket that holds a pair.
    """
    bands = 64 * words // BAND

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch.iloc[np.repeat(np.arange(len(batch)), bands)]
            yield out.assign(bucket=(_bands(b"".join(batch["wide"]), words) + (np.arange(bands) << BAND)).ravel())

    placed = rows.mapInPandas(place, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", bucket long")
    sizes = stored(chunks(placed), "band-sizes")
    total = sizes.agg(F.coalesce(F.sum(F.col("n") * F.col("chunks")), F.lit(0)).alias("n")).first()["n"]
    tasks = max(1, -(-total // TASK_ROWS))
    # sizes has at most bands * 2 ** BAND rows, whatever the input
    dealt = placed.join(F.broadcast(sizes.select("bucket", "chunks")), "bucket")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64(*rows.columns), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.select(*rows.columns, "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                         (F.col("own") > F.col("other")).alias("later"))
    return dealt.withColumn("task", F.pmod(F.xxhash64("bucket", "low", "high"), F.lit(tasks)))


def _bands(wides: bytes, words: int) -> np.ndarray:
    """The number in each band, a row for each fingerprint."""
    bands = 64 * words // BAND
    bits = np.unpackbits(np.frombuffer(wides, np.uint8).reshape(-1, 8 * words), axis=1)[:, : bands * BAND].reshape(-1, bands, BAND)
    return (bits * (1 << np.arange(BAND))).sum(2)


def band_links(wides: DataFrame, words: int, agreement: float) -> DataFrame:
    """Links ``a, b`` (first 64 bits) that connect all of column ``wide`` that share a band and agree in that share of their bits."""
    limit = int(64 * words * (1 - agreement) + 1e-9)

    def chunks(placed: DataFrame) -> DataFrame:
        sizes = placed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        return sizes.withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("int"))

    dealt = _tiles(wides.select("wide"), words, chunks)

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bucket", "low", "high", "later"], kind="stable")
        table = np.frombuffer(b"".join(frame["wide"]), "<u8").reshape(-1, words)
        tile, later = frame[["bucket", "low", "high"]].to_numpy(np.int64), frame["later"].to_numpy()
        cuts = np.flatnonzero((tile[1:] != tile[:-1]).any(1)) + 1
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(table)]):
            within = tile[begin, 1] == tile[begin, 2]
            middle = end if within else begin + int((~later[begin:end]).sum())
            for at in range(begin, middle, 256):
                left, right = table[at : min(at + 256, middle)], table[at if within else middle : end]
                gap = np.zeros((len(left), len(right)), np.int16)
                for j in range(words):
                    gap += np.bitwise_count(left[:, None, j] ^ right[None, :, j])
                near = gap <= limit
                if within:
                    np.fill_diagonal(near, False)
                x, y = _spanning(near)
                rows = np.concatenate([left[:, 0], right[:, 0]]).view(np.int64)
                a.append(rows[x])
                b.append(rows[y])
        node, root = forest(np.concatenate(a), np.concatenate(b))
        return pd.DataFrame({"a": node, "b": root})

    return dealt.groupBy("task").applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int, radius: int = 3, blocks: int = BLOCKS, words: int = 1, agreement: float = 1.0) -> DataFrame:
    """doc_id, fp, component_id: the least doc_id that is reachable by links."""
    marks = stored(fingerprints(docs, shingle, words), "fingerprints")
    distinct = marks.groupBy("fp").agg(F.min("doc_id").alias("least"))
    links = near_links(distinct.select("fp"), radius, blocks)
    if words > 1:
        links = links.union(band_links(stored(marks.select("wide").distinct(), "wide-fingerprints"), words, agreement))
    roots = components(links)
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = stored(named, "roots")
    groups = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return marks.join(named.join(groups, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def candidate_groups(nodes: DataFrame, words: int, agreement: float, similarity: float) -> DataFrame:
    """group, node, n: in each group nodes of which some may be similar; every candidate pair is together in one group at least."""
    limit = int(64 * words * (1 - agreement) + 1e-9)

    def chunks(placed: DataFrame) -> DataFrame:
        sizes = placed.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("size").alias("shingles")).where("n > 1")
        need = F.greatest(F.ceil(F.col("n") / CHUNK), F.ceil(F.col("shingles") / CHUNK_SHINGLES), F.lit(1))
        return sizes.select("bucket", "n", need.cast("int").alias("chunks"))

    dealt = _tiles(nodes.select("node", "wide", "size"), words, chunks)

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bucket", "low", "high", "later"], kind="stable")
        wides = b"".join(frame["wide"])
        table, bands = np.frombuffer(wides, "<u8").reshape(-1, words), _bands(wides, words).astype(np.int16)
        node, size = frame["node"].to_numpy(np.int64), frame["size"].to_numpy(np.float64)
        tile, later = frame[["bucket", "low", "high"]].to_numpy(np.int64), frame["later"].to_numpy()
        cuts = np.flatnonzero((tile[1:] != tile[:-1]).any(1)) + 1
        out = []
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(table)]):
            within, band = tile[begin, 1] == tile[begin, 2], int(tile[begin, 0] >> BAND)
            middle = end if within else begin + int((~later[begin:end]).sum())
            a, b = [], []
            for at in range(begin, middle, 256):
                to, first = min(at + 256, middle), at if within else middle
                gap = np.zeros((to - at, end - first), np.int16)
                for j in range(words):
                    gap += np.bitwise_count(table[at:to, None, j] ^ table[None, first:end, j])
                near = gap <= limit
                if within:
                    np.fill_diagonal(near, False)
                x, y = np.nonzero(near)
                if not len(x):
                    continue
                x, y = x + at, y + first
                ratio = np.minimum(size[x], size[y]) >= similarity * np.maximum(size[x], size[y]) - 1e-6
                x, y = x[ratio], y[ratio]
                new = np.ones(len(x), bool)  # an earlier band that both share has the pair already
                for i in range(band):
                    new[new] = bands[x[new], i] != bands[y[new], i]
                x, y = x[new], y[new]
                if len(x):
                    x, y = forest(x, y)
                    a.append(x)
                    b.append(y)
            if not a:
                continue
            x, root = forest(np.concatenate(a), np.concatenate(b))
            tops = np.unique(root)
            of, top = np.concatenate([x, tops]), np.concatenate([root, tops])
            out.append((mix((tile[begin] + [0, 1 << 20, 1 << 40]).astype(np.uint64)).sum() ^ mix(top.astype(np.uint64)), of))
        group = np.concatenate([np.zeros(0, np.uint64), *[g for g, _ in out]])
        of = np.concatenate([np.zeros(0, np.int64), *[o for _, o in out]])
        return pd.DataFrame({"group": group.view(np.int64), "node": node[of], "n": size[of].astype(np.int64)})

    return dealt.groupBy("task").applyInPandas(compare, "group long, node long, n long")


def similar(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """For each of the sets (distinct hashes), the first that it is connected with by pairs of at least that Jaccard similarity."""
    n, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    if n == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([0, 0 if both >= similarity * (sizes.sum() - both) - 1e-9 else 1])
    _, ids, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    common = counts[ids] > 1  # what only one set has is in no intersection
    ids, owner = ids[common], owner[common]
    order = np.argsort(ids, kind="stable")
    posted, ends = owner[order], np.cumsum(np.bincount(ids, minlength=len(counts)))
    many = np.bincount(ids, minlength=len(counts))
    own = np.split(ids, np.cumsum(np.bincount(owner, minlength=n))[:-1])
    label, free = np.full(n, -1), np.ones(n, bool)
    for first in range(n):
        if not free[first]:
            continue
        label[first], free[first], waiting = first, False, [first]
        while waiting and free.any():
            i = waiting.pop()
            both, at = np.zeros(n, np.int64), 0
            while at < len(own[i]):  # some of its shingles at a time
                part = own[i][at : at + max(1, (4 << 20) // n)]
                size, low = many[part], ends[part] - many[part]
                both += np.bincount(posted[np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)], minlength=n)
                at += len(part)
            found = np.flatnonzero(free & (both >= similarity * (sizes[i] + sizes - both) - 1e-9))
            label[found], free[found] = first, False
            waiting += found.tolist()
    return label


def similar_documents(docs: DataFrame, shingle: int, words: int, agreement: float, similarity: float) -> DataFrame:
    """doc_id, component_id: the least doc_id that is reachable by pairs of that similarity. No null or repeated doc_id."""
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            sets = [np.unique(shingle_hashes(t, shingle)) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "node": [np.uint64(xxh64_intdigest(s.tobytes())).view(np.int64) for s in sets],
                                "size": [len(s) for s in sets], "wide": [_marks(s, words).astype("<u8").tobytes() for s in sets]})

    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    marks = stored(docs.mapInPandas(make, f"doc_id {kind}, node long, size long, wide binary"), "shingle-sets")
    nodes = marks.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("size").alias("size"), F.first("wide").alias("wide"))
    nodes = stored(nodes, "nodes")
    groups = stored(candidate_groups(nodes, words, agreement, similarity), "candidates")
    tasks = max(1, -(-(groups.agg(F.sum("n").alias("n")).first()["n"] or 0) // TASK_SHINGLES))
    asked = groups.select("node").distinct().join(nodes.select("node", "least"), "node")
    asked = asked.join(docs.withColumnRenamed("doc_id", "least"), "least").select("node", "text")
    dealt = groups.join(asked, "node").select("group", "node", "text", F.pmod(F.xxhash64("group"), F.lit(tasks)).alias("task"))

    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        frame = frame.sort_values(["group", "node"], kind="stable")
        group, node, texts = frame["group"].to_numpy(np.int64), frame["node"].to_numpy(np.int64), frame["text"].to_numpy()
        cuts = np.flatnonzero(group[1:] != group[:-1]) + 1
        held: dict[int, np.ndarray] = {}
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(group)]):
            own = node[begin:end]
            for i, text in zip(own.tolist(), texts[begin:end]):
                if i not in held:
                    held[i] = np.unique(shingle_hashes(text, shingle))
            a.append(own)
            b.append(own[similar([held[i] for i in own.tolist()], similarity)])
        node, root = forest(np.concatenate(a), np.concatenate(b))
        return pd.DataFrame({"a": node, "b": root})

    roots = components(dealt.groupBy("task").applyInPandas(settle, "a long, b long"))
    named = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    named = stored(named, "roots")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return marks.join(named.join(least, "root").select("node", "component_id"), "node").select("doc_id", "component_id")
