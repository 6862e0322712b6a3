"""Removal of byte strings that start earlier elsewhere, by column-wise construction of a collection's suffix order.

A string of ``length`` bytes is aligned by its anchor: the least hash of ``GRAM`` bytes in it. Equal strings have equal anchors at the
same place, so only stretches around anchors that occur more than once are compared, and only with stretches of the same anchor. (One
insertion round for each byte of the longest document, over all documents, would read the whole order as often as that; aligned
stretches need one round for each of their columns.) A bucket of stretches is a collection of short documents in which one symbol of
each is inserted in every round, from the right to the left. The round's symbols, read in the order so far, are a column of the
collection's Burrows-Wheeler transform; a stable sort by them is the new order, and the common prefix of neighbours is one more than
the least common prefix between their old places. Strings are equal where the common prefix reaches ``length``. Equality is decided by
the bytes, but for hot anchors and inside a block.

An anchor that stands in ever different surroundings would make its bucket grow with the input. Blocks send how many stretches they
have of each anchor; one with more than ``HOT`` in all, or ``MOST`` in a block, is hot. Its strings go out one by one instead, each
distinct one once for a block, to a bucket of the string's own hashes, so that they spread and equal ones still meet; there, as
inside a block, two 64-bit hashes stand for the bytes.

Stretches go to a bucket once for each block and content, so copies of a document or passage meet once for each block that holds
them. Null and empty texts have no bytes; texts shorter than ``length`` lose none. Rows with equal ids are put in the order of the
scan, null ids last. Columns other than doc_id and text are not read. The table must be a stable scan (see ``scans``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm import lookup
from salescope.llm.ragged import BASE_A, BASE_B, BYTE_VALUES, inverse, mix, powers, stretch_hashes
from salescope.llm.scans import cut, for_part, kept_by_part

GRAM = 32
BLOCK_CHARS = 6 << 20
BUCKET_BYTES = 12 << 20
#: Bytes hashed at once, so that the arrays over them stay in the cache.
WORK_BYTES = 1 << 18
#: Bytes that leave a task in one frame.
FRAME_BYTES = 4 << 20
HOT, MOST = 8192, 255
ABSENT = 0xFF  # never a byte of UTF-8


def least_after(h: np.ndarray, width: int) -> np.ndarray:
    """For each place, where the least of the next ``width`` values stands (the last one of equals)."""
    best, at, have = h, np.arange(len(h), dtype=np.int64), 1
    while have < width:
        step = min(have, width - have)
        n = len(best) - step
        if n <= 0:
            return np.zeros(0, np.int64)
        later = best[step:] <= best[:n]
        at = np.where(later, at[step:], at[:n])
        best = np.where(later, best[step:], best[:n])
        have += step
    return at


def firsts(*keys: np.ndarray) -> np.ndarray:
    """Where each distinct row of the key columns first stands."""
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
    return order[new]


def frames(records: Iterator[tuple], names: list[str]) -> Iterator[pd.DataFrame]:
    """Records, the columns of bytes last, some MB to a frame: each block has some for every bucket, and a frame takes milliseconds."""
    first = names.index("ids")
    held, size = [], 0
    for record in records:
        held.append(record)
        size += sum(len(column) for column in record[first:] if column is not None)
        if size >= FRAME_BYTES:
            yield pd.DataFrame(held, columns=names)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=names)


class Stretches:
    """The anchored stretches of a block: row, start (place in the block's bytes), number of strings, anchor and its hash."""

    def __init__(self, rows: pd.DataFrame, length: int):
        self.texts = [t.encode() if t else b"" for t in rows["text"]]
        self.raw = np.frombuffer(b"".join(self.texts), np.uint8)
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.begin = np.cumsum(sizes) - sizes
        row, start, many, anchor, hashes = ([np.zeros(0, t)] for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
        group, held = [], 0
        for i in [*np.flatnonzero(sizes >= length).tolist(), None]:
            if group and (i is None or held + sizes[i] > WORK_BYTES):
                for out, found in zip((row, start, many, anchor, hashes), self._anchors(np.array(group), sizes, length)):
                    out.append(found)
                group, held = [], 0
            if i is not None:
                group.append(i)
                held += sizes[i]
        self.row, self.start, self.many, self.anchor, self.hash = map(np.concatenate, (row, start, many, anchor, hashes))

    def _anchors(self, group: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
        """Of a run of neighbouring texts, shorter ones between them included."""
        low, high = self.begin[group[0]], self.begin[group[-1]] + sizes[group[-1]]
        values = BYTE_VALUES[self.raw[low:high]]
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers(BASE_A, len(values)), out=sums[1:])
        h = mix((sums[GRAM:] - sums[:-GRAM]) * powers(inverse(BASE_A), len(values) + 1)[: len(values) - GRAM + 1])
        at = least_after(h, length - GRAM + 1)
        count = sizes[group] - length + 1
        starts = np.repeat(self.begin[group] - low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        row, anchor = np.repeat(group, count), at[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        return row[first], starts[first] + low, np.diff(np.append(first, len(starts))), anchor[first] + low, h[anchor[first]]

    def sent(self, buckets: int) -> lookup.Sent:
        return lookup.sent(self.hash, self.hash >> np.uint64(24), buckets)

    def first_copies(self, rank: np.ndarray, length: int) -> np.ndarray:
        """Which stretches are the earliest with their content in this block; ``rank`` puts the rows in order.

        One whose anchor occurs only once here is; contents are hashed for the others alone.
        """
        by_hash = np.argsort(self.hash)
        equal = self.hash[by_hash[1:]] == self.hash[by_hash[:-1]]
        shared = np.zeros(len(by_hash), bool)
        shared[by_hash[1:][equal]] = shared[by_hash[:-1][equal]] = True
        which = np.flatnonzero(shared)
        start = self.start[which]
        ends = start + self.many[which] + length - 1
        order = np.lexsort((start, rank[self.row[which]]))
        left = (self.anchor[which] - start)[order].astype(np.uint64)
        contents = (self._contents(base, start, ends)[order] + left for base in (BASE_A, BASE_B))
        out = ~shared
        out[which[order[firsts(self.hash[which][order], *contents)]]] = True
        return out

    def first_strings(self, which: np.ndarray, rank: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, start, whether it is the earliest of its content here, and two hashes of each string of those stretches."""
        many = self.many[which]
        row = np.repeat(self.row[which], many)
        start = np.repeat(self.start[which] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        order = np.lexsort((start, rank[row]))
        row, start = row[order], start[order]
        key, by_place = np.empty((len(start), 2), np.uint64), np.argsort(start)
        ordered, at = start[by_place], 0
        while at < len(start):
            to = max(at + 1, int(np.searchsorted(ordered, ordered[at] + (WORK_BYTES))))
            own, low = ordered[at:to] - ordered[at], ordered[at]
            values = BYTE_VALUES[self.raw[low : ordered[to - 1] + length]]
            for column, base in enumerate((BASE_A, BASE_B)):
                key[by_place[at:to], column] = mix(stretch_hashes(values, own, own + length, base))
            at = to
        new = np.zeros(len(start), bool)
        new[firsts(key[:, 0], key[:, 1])] = True
        return row, start, new, key

    def _contents(self, base: np.uint64, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of stretches in the order of their starts."""
        out, at = np.empty(len(ends), np.uint64), 0
        while at < len(ends):
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + (WORK_BYTES))))
            low = starts[at]
            out[at:to] = stretch_hashes(BYTE_VALUES[self.raw[low : ends[at:to].max()]], starts[at:to] - low, ends[at:to] - low, base)
            at = to
        return out


def repeats(table: np.ndarray, length: int, columns: int) -> np.ndarray:
    """Which strings that begin in the first ``columns`` columns of aligned rows also begin in an earlier row, at the same column."""
    n, width = table.shape
    out = np.zeros((n, columns), bool)
    order, common = np.arange(n), np.zeros(n, np.uint8)
    symbols = np.ascontiguousarray(table.T)
    for column in range(width - 1, -1, -1):
        bwt = symbols[column][order]  # what precedes each suffix, in their order
        place = np.argsort(bwt, kind="stable")
        levels = [common]
        low, high = place[:-1] + 1, place[1:]
        same = bwt[place[1:]] == bwt[place[:-1]]
        span = np.where(same, high - low + 1, 1)
        for half in range(int(span.max()).bit_length() - 1 if n > 1 else 0):
            last = levels[-1]
            levels.append(np.minimum(last[: len(last) - (1 << half)], last[1 << half :]))
        new = np.zeros(n, np.uint8)
        level = np.frexp(span.astype(np.float64))[1] - 1
        for i, least in enumerate(levels):
            at = np.flatnonzero(same & (level == i))
            new[at + 1] = np.minimum(np.minimum(least[low[at]], least[high[at] - (1 << i) + 1]), length) + 1
        order, common = order[place], np.minimum(new, length)
        if column < columns and (common >= length).any():
            begins = np.flatnonzero(common < length)
            earliest = np.minimum.reduceat(order, begins)
            later = order != np.repeat(earliest, np.diff(np.append(begins, n)))
            out[order[later], column] = True
    return out


def removed_bytes(docs: DataFrame, length: int = 100, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (from, to) in bytes, and kept (binary) if asked for."""
    docs = docs.select("doc_id", "text")
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    columns = length - GRAM + 1
    key_buckets, buckets = lookup.buckets_for(total // 30), 1 << max(0, int(total // BUCKET_BYTES)).bit_length()

    def blocks(batches: Iterator[pd.DataFrame]):
        for part, block, rows in cut(batches, BLOCK_CHARS):
            rank = np.argsort(rows["doc_id"].argsort(kind="stable").to_numpy(), kind="stable") if rows["doc_id"].notna().all() else (
                rows["doc_id"].rank(method="first", na_option="bottom").to_numpy().astype(np.int64))
            yield part, block, rows, rank, Stretches(rows, length)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, block, rows, rank, found in blocks(batches):
            sent = found.sent(key_buckets)
            first = found.first_copies(rank, length)[sent.order]
            many = np.minimum(np.add.reduceat(first, sent.places, dtype=np.int64), MOST) if len(sent.places) else np.zeros(0)
            cuts = np.cumsum([len(own) for _, own in sent.parts])[:-1]
            yield pd.DataFrame([(part, block, len(rows), bucket, len(own), found.hash[own].tobytes(), m.tobytes())
                                for (bucket, own), m in zip(sent.parts, np.split(many.astype(np.uint8), cuts))],
                               columns=["part", "block", "n_rows", "bucket", "n", "keys", "many"])

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.frombuffer(k, np.uint64) for k in frame["keys"]])
        _, place, count = np.unique(keys, return_inverse=True, return_counts=True)
        out = frame[["part", "block", "n_rows", "bucket", "n"]].copy()
        many = np.concatenate([np.frombuffer(m, np.uint8) for m in frame["many"]])
        most = np.zeros(len(count), np.uint8)
        np.maximum.at(most, place, many)
        hot = (np.bincount(place, many) > HOT) | (most >= MOST)
        cuts = np.cumsum(frame["n"].to_numpy())[:-1]
        out["bits"] = [np.packbits(x).tobytes() for x in np.split(count[place] > 1, cuts)]
        out["hot"] = [np.packbits(x).tobytes() for x in np.split(hot[place], cuts)]
        return out

    layout = "part int, block int, n_rows long, bucket int, n int"
    shared = docs.mapInPandas(send, f"{layout}, keys binary, many binary").groupBy("bucket").applyInPandas(merge, f"{layout}, bits binary, hot binary")
    folder = kept_by_part(shared, "anchors")

    def answers(waiting: pd.DataFrame, block: int, rows: pd.DataFrame, found: Stretches) -> tuple[np.ndarray, np.ndarray]:
        """For each stretch, whether its anchor occurs again and whether it is hot."""
        own = waiting[waiting["block"] == block].sort_values("bucket")
        sent = found.sent(key_buckets)
        if not (own["n_rows"] == len(rows)).all() or own["n"].sum() != len(sent.places):
            raise RuntimeError("the scan's partitions have changed between passes")
        if not len(own):
            return np.zeros(0, bool), np.zeros(0, bool)
        bits, hot = (np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(own[c], own["n"])]).astype(bool) for c in ("bits", "hot"))
        return sent.spread(bits | (sent.counts() > 1)), sent.spread(hot)

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        waiting = None
        for part, block, rows, rank, found in blocks(batches):
            if waiting is None:
                waiting = for_part(folder, part, ["block", "n_rows", "bucket", "n", "bits", "hot"])
            again, hot = answers(waiting, block, rows, found)
            ids = rows["doc_id"].fillna(np.iinfo(np.int64).max).to_numpy(np.int64)
            again &= found.first_copies(rank, length)
            row, start, new, key = found.first_strings(np.flatnonzero(again & hot), rank, length)
            row, start, key = row[new], start[new], key[new]
            bucket = ((key[:, 1] >> np.uint64(40)) & np.uint64(4 * buckets - 1)).astype(np.int64) + buckets  # after those of stretches
            order = np.argsort(bucket, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else ():
                yield (part, block, int(bucket[own[0]]), len(own), ids[row[own]].tobytes(), row[own].tobytes(),
                       (start[own] - found.begin[row[own]]).tobytes(), None, None, key[own].tobytes())
            go = np.flatnonzero(again & ~hot)
            if not len(go):
                continue
            bucket = (found.hash[go] >> np.uint64(40)) & np.uint64(buckets - 1)
            go = go[np.argsort(bucket, kind="stable")]
            bucket = (found.hash[go] >> np.uint64(40)) & np.uint64(buckets - 1)
            for own in np.split(go, np.flatnonzero(np.diff(bucket)) + 1):
                size = found.many[own] + length - 1
                flat = np.repeat(found.start[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                yield (part, block, int((found.hash[own[0]] >> np.uint64(40)) & np.uint64(buckets - 1)), len(own),
                       ids[found.row[own]].tobytes(), found.row[own].tobytes(), (found.start[own] - found.begin[found.row[own]]).tobytes(),
                       found.many[own].astype(np.uint8).tobytes(), (found.anchor[own] - found.start[own]).astype(np.uint8).tobytes(),
                       found.raw[flat].tobytes())

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        ids, rows, starts = (np.concatenate([np.frombuffer(b, np.int64) for b in frame[c]]) for c in ("ids", "rows", "starts"))
        part, block = (np.repeat(frame[c].to_numpy(), frame["n"]) for c in ("part", "block"))
        if frame["bucket"].iloc[0] >= buckets:  # strings of hot anchors
            key = np.frombuffer(b"".join(frame["bytes"]), np.uint64).reshape(-1, 2)
            order = np.lexsort((starts, rows, block, part, ids, key[:, 1], key[:, 0]))
            of = order[1:][(key[order[1:]] == key[order[:-1]]).all(1)]
            return pd.DataFrame({"part": part[of], "block": block[of], "row": rows[of], "low": starts[of], "high": starts[of] + length})
        many, left = (np.concatenate([np.frombuffer(b, np.uint8) for b in frame[c]]).astype(np.int64) for c in ("many", "left"))
        raw = np.frombuffer(b"".join(frame["bytes"]), np.uint8)
        size = many + length - 1
        begin = np.cumsum(size) - size
        order = np.lexsort((starts, rows, block, part, ids))
        width = columns + length - 1
        table = np.full(len(order) * width, ABSENT, np.uint8)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        shift, at = place * width + columns - 1 - left - begin, 0
        while at < len(order):
            to = max(at + 1, int(np.searchsorted(begin, begin[at] + WORK_BYTES)))
            low, high = begin[at], begin[to - 1] + size[to - 1]
            table[np.repeat(shift[at:to], size[at:to]) + np.arange(low, high)] = raw[low:high]
            at = to
        table = table.reshape(-1, width)
        gone = repeats(table, length, columns)
        first, column = (columns - 1 - left[order])[:, None], np.arange(columns)[None, :]
        gone &= (column >= first) & (column < first + many[order][:, None])  # absent symbols match as well
        edges = np.diff(np.pad(gone, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, low = np.nonzero(edges == 1)
        _, high = np.nonzero(edges == -1)
        of = order[row]
        from_ = starts[of] + low - (columns - 1 - left[of])
        return pd.DataFrame({"part": part[of], "block": block[of], "row": rows[of], "low": from_, "high": from_ + (high - low) + length - 1})

    names = ["part", "block", "bucket", "n", "ids", "rows", "starts", "many", "left", "bytes"]
    sent = docs.mapInPandas(lambda batches: frames(stretches(batches), names),
                            "part int, block int, bucket int, n int, ids binary, rows binary, starts binary, many binary, left binary, bytes binary")
    spans = sent.groupBy("bucket").applyInPandas(compare, "part int, block int, row long, low long, high long")
    later = kept_by_part(spans, "repeats")

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting = asked = None
        for part, block, rows, rank, found in blocks(batches):
            if waiting is None:
                waiting = for_part(later, part, ["block", "row", "low", "high"])
                asked = for_part(folder, part, ["block", "n_rows", "bucket", "n", "bits", "hot"])
            again, hot = answers(asked, block, rows, found)
            own = waiting[waiting["block"] == block]
            copy = ~found.first_copies(rank, length)
            _, start, new, _ = found.first_strings(np.flatnonzero(again & hot & ~copy), rank, length)
            begin = found.begin[own["row"].to_numpy(np.int64)]
            low = np.concatenate([found.start[copy], start[~new], begin + own["low"].to_numpy(np.int64)])
            high = np.concatenate([(found.start + found.many + length - 1)[copy], start[~new] + length, begin + own["high"].to_numpy(np.int64)])
            steps = np.bincount(low, minlength=len(found.raw) + 1)
            steps -= np.bincount(high, minlength=len(found.raw) + 1)
            gone = np.cumsum(steps, out=steps) > 0
            out = []
            for doc, text, at in zip(rows["doc_id"], found.texts, found.begin):
                lost = gone[at : at + len(text)]
                n = int(lost.sum())
                edges = np.flatnonzero(np.diff(np.pad(lost.astype(np.int8), 1))).reshape(-1, 2).tolist() if n else []
                kept = found.raw[at : at + len(text)][~lost].tobytes() if n else text
                out.append((doc, len(text), n, len(edges), hashlib.sha256(kept).hexdigest(), edges, kept if keep_text else None))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    out = docs.mapInPandas(finish, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, "
                                   "kept_sha256 string, spans array<array<int>>, kept binary")
    return out if keep_text else out.drop("kept")
