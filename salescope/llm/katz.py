"""Katz backoff language model over words.

Words and word pairs of the training texts are counted: blocks send their distinct keys with counts to buckets, whose totals are the
partitioned n-gram tables. Counts up to ``CUT`` are discounted by Good-Turing from the tables' counts of counts. A pair seen in
training has its discounted relative frequency; any other has its context's backoff weight times the probability of the word, down
to the mass that discounting leaves for all unknown words together. The weight of a context is (1 - sum of its pairs' probabilities)
/ (1 - sum of their words' probabilities), summed over all blocks, each distinct pair by the one block that was told to own it; so the
probabilities after any context add up to 1. A context whose counts are all above the cut gives one count's share to the rest.

Keys are 64-bit hashes, a pair's bucket comes from a second one. Null and empty texts are one end token. Equal rows score alike; a null
``train`` counts as training. An empty table gives no rows; without training texts every token is unknown, with probability 1 for the
one unknown class. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm import lookup
from salescope.llm.common import stored
from salescope.llm.ragged import BASE_B, Words, mix
from salescope.llm.scans import cut, for_part, kept_by_part

CUT = 5
START, END = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


class Tokens:
    """Tokens of a block: hashes, contexts, the text of each, and which are for training."""

    def __init__(self, rows: pd.DataFrame):
        words = Words([t.encode().lower() if t else b"" for t in rows["text"]])
        sizes = words.last - words.first
        ends = np.cumsum(sizes + 1) - 1
        self.token = np.full(int(sizes.sum()) + len(rows), END, np.uint64)
        inner = np.ones(len(self.token), bool)
        inner[ends] = False
        self.token[inner] = words.hashes()
        self.context = np.roll(self.token, 1)
        self.context[ends - sizes] = START
        self.begin, self.sizes = ends - sizes, sizes + 1
        self.train = np.repeat(rows["train"].to_numpy(bool), self.sizes)

    def sent(self, buckets: int) -> dict[int, lookup.Sent]:
        pair = mix(mix(self.context) * BASE_B + self.token)
        return {1: lookup.sent(self.token, self.token >> np.uint64(32), buckets),
                2: lookup.sent(pair, mix(self.token * BASE_B ^ self.context), buckets)}

    def contexts(self, sent: lookup.Sent) -> lookup.Sent:
        """The contexts, from the tokens' keys: each token's places moved on by one, so that a start goes where an end does."""

        def after(places: np.ndarray) -> np.ndarray:
            return (places + 1) % len(self.token)

        return lookup.Sent(after(sent.order), sent.places, [(bucket, after(own)) for bucket, own in sent.parts], sent.n)


class Discount:
    """Good-Turing factors from counts of counts 1..CUT+1.

    Where the counts don't decline as they should, as with many copies in the texts, their log-linear trend stands for them (simple
    Good-Turing); where there is no declining trend either, as in a few texts, a constant is taken off each count.
    """

    def __init__(self, counts: np.ndarray):
        n = np.concatenate(([0], np.asarray(counts, float)))
        self.absolute, self.factor = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5, None
        r = np.arange(1, CUT + 1)
        if n[1] and (n[1:] > 0).sum() > 1:
            some = np.flatnonzero(n[1:]) + 1
            slope = np.polyfit(np.log(some), np.log(n[some]), 1)[0]
            trend = np.concatenate(([0], np.exp(slope * np.log(np.arange(1, CUT + 2)))))
            for m in ([n] if (n[1:] > 0).all() else []) + [trend]:
                rest = (CUT + 1) * m[CUT + 1] / m[1]
                factor = ((r + 1) * m[r + 1] / (r * m[r]) - rest) / (1 - rest) if rest < 1 else np.zeros(CUT)
                if ((factor > 0) & (factor < 1)).all():
                    self.factor = np.concatenate(([0], factor))
                    break

    def __call__(self, count: np.ndarray) -> np.ndarray:
        """The discounted count."""
        if self.factor is None:
            return np.maximum(count - self.absolute, 0)
        return np.where(count <= CUT, self.factor[np.minimum(count, CUT)], 1) * count


def _narrow(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def _blobs(out: lookup.Sent, values: np.ndarray, narrow: bool = False) -> list[bytes]:
    """One value for each distinct key, cut by bucket."""
    parts = np.split(values, np.cumsum([len(own) for _, own in out.parts])[:-1])
    return [(_narrow(part) if narrow else part).tobytes() for part in parts]


def _messages(out: lookup.Sent, **columns) -> pd.DataFrame:
    """A row for each bucket, all in one frame: a frame costs a thousand times what a row does, and both numbers of blocks and
    buckets grow with the input."""
    return pd.DataFrame({"bucket": [bucket for bucket, _ in out.parts], "n": [len(own) for _, own in out.parts], **columns})


def _wide(blobs: pd.Series, sizes: pd.Series, kind=None) -> np.ndarray:
    parts = [np.frombuffer(b, kind or f"u{len(b) // n}").astype(kind or np.int64) for b, n in zip(blobs, sizes)]
    return np.concatenate(parts) if parts else np.zeros(0, kind or np.int64)


def score(docs: DataFrame) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score, score from ``doc_id, text, train``."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    docs = docs.select("doc_id", "text", F.coalesce("train", F.lit(True)).alias("train"))
    buckets = lookup.buckets_for(total // 6)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, block, rows in cut(batches):
            tokens = Tokens(rows)
            for order, out in tokens.sent(buckets).items():
                counts = np.add.reduceat(tokens.train[out.order].astype(np.int64), out.places)
                own = out.order[out.places]
                keys = tokens.token[own] if order == 1 else mix(mix(tokens.context[own]) * BASE_B + tokens.token[own])
                yield _messages(out, order=order, part=part, block=block, n_rows=len(rows), keys=_blobs(out, keys), counts=_blobs(out, counts, narrow=True))

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.frombuffer(k, np.uint64) for k in frame["keys"]])
        counts = _wide(frame["counts"], frame["n"])
        order = np.argsort(keys, kind="stable")
        new = np.ones(len(keys), bool)
        new[1:] = keys[order][1:] != keys[order][:-1]
        sums = np.add.reduceat(counts[order], np.flatnonzero(new))
        answer, owner = np.empty(len(keys), np.int64), np.zeros(len(keys), bool)
        answer[order] = sums[np.cumsum(new) - 1]
        owner[order] = new
        cuts = np.cumsum(frame["n"].to_numpy())[:-1]
        seen = sums > 0
        table = [-1, 0, 0, frame["order"].iloc[0], frame["bucket"].iloc[0], int(seen.sum()), _narrow(sums[seen]).tobytes(),
                 keys[order][new][seen].tobytes(), [*np.bincount(np.minimum(sums, CUT + 2), minlength=CUT + 2)[1 : CUT + 2].tolist(), int(sums.sum())]]
        rows = [[p, b, r, o, k, n, _narrow(a).tobytes(), np.packbits(w).tobytes(), None] for p, b, r, o, k, n, a, w in zip(
            frame["part"], frame["block"], frame["n_rows"], frame["order"], frame["bucket"], frame["n"], np.split(answer, cuts), np.split(owner, cuts))]
        return pd.DataFrame([table, *rows], columns=["part", "block", "n_rows", "order", "bucket", "n", "counts", "keys", "stats"])

    messages = docs.mapInPandas(send, "order int, part int, block int, n_rows long, bucket int, n int, keys binary, counts binary")
    merged = messages.groupBy("order", "bucket").applyInPandas(
        merge, "part int, block int, n_rows long, order int, bucket int, n int, counts binary, keys binary, stats array<long>")
    merged = stored(merged, "ngrams")  # a row for each bucket of the n-gram tables (part -1), and the answers to the blocks
    tables = merged.where("part = -1")
    folder = kept_by_part(merged.where("part >= 0").drop("stats"), "counts")
    sums = {r["order"]: r for r in tables.groupBy("order").agg(F.sum("n").alias("v"), *[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(CUT + 2)]).collect()}
    n_tokens = sums[1][f"s{CUT + 1}"] if 1 in sums else 0
    n_types = sums[1]["v"] if 1 in sums else 0
    single, double = (Discount([sums[o][f"s{i}"] if o in sums else 0 for i in range(CUT + 1)]) for o in (1, 2))
    if single.factor is None:
        left = single.absolute * n_types
    else:
        left = sum((1 - single.factor[r]) * r * sums[1][f"s{r - 1}"] for r in range(1, CUT + 1))
    unknown = left / n_tokens if n_tokens else 1.0

    def alone(count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, single(count) / max(n_tokens, 1), unknown)

    def answered(batches: Iterator[pd.DataFrame]):
        """Each block with its contexts' keys, the training counts of its tokens, pairs and contexts, and which pairs it owns."""
        waiting = None
        for part, block, rows in cut(batches):
            if waiting is None:
                waiting = for_part(folder, part, ["block", "n_rows", "order", "bucket", "n", "counts", "keys"])
            tokens, found = Tokens(rows), {}
            sent = tokens.sent(buckets)
            for order in (1, 2):
                own = waiting[(waiting["block"] == block) & (waiting["order"] == order)].sort_values("bucket")
                if not (own["n_rows"] == len(rows)).all() or own["n"].sum() != len(sent[order].places):
                    raise RuntimeError("the scan's partitions have changed between passes")
                found[order] = _wide(own["counts"], own["n"])
                if order == 2:
                    owned = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(own["keys"], own["n"])])
            count, pair = sent[1].spread(found[1]), sent[2].spread(found[2])
            before = np.roll(count, 1)
            ends = count[tokens.begin + tokens.sizes - 1]
            before[tokens.begin] = ends  # as many starts as ends
            first = sent[2].order[sent[2].places]
            yield part, block, rows, tokens, tokens.contexts(sent[1]), count, pair, before, first[owned.astype(bool) & (found[2] > 0)]

    def mass(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, block, _, tokens, out, count, pair, before, own in answered(batches):
            seen, below = np.zeros(len(count)), np.zeros(len(count))
            seen[own] = double(pair[own]) / before[own]
            below[own] = alone(count[own])
            a, b = np.add.reduceat(seen[out.order], out.places), np.add.reduceat(below[out.order], out.places)
            yield _messages(out, part=part, block=block, keys=_blobs(out, tokens.context[out.order[out.places]]), seen=_blobs(out, a), below=_blobs(out, b))

    def weigh(frame: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.frombuffer(k, np.uint64) for k in frame["keys"]])
        _, place = np.unique(keys, return_inverse=True)
        cuts = np.cumsum(frame["n"].to_numpy())[:-1]
        out = frame[["part", "block", "bucket", "n"]].copy()
        for name in ("seen", "below"):
            sums = np.bincount(place, weights=_wide(frame[name], frame["n"], np.float64))[place]
            out[name] = [x.tobytes() for x in np.split(sums, cuts)]
        return out

    sent = docs.mapInPandas(mass, "part int, block int, bucket int, n int, keys binary, seen binary, below binary")
    weights = kept_by_part(sent.groupBy("bucket").applyInPandas(weigh, "part int, block int, bucket int, n int, seen binary, below binary"), "backoff")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting = None
        for part, block, rows, tokens, out, count, pair, before, _ in answered(batches):
            if waiting is None:
                waiting = for_part(weights, part, ["block", "bucket", "n", "seen", "below"])
            own = waiting[waiting["block"] == block].sort_values("bucket")
            seen, below = (out.spread(_wide(own[c], own["n"], np.float64)) for c in ("seen", "below"))
            full = seen > 1 - 1e-9  # no mass is left over
            known = np.maximum(before, 1)
            scale = np.where(full, known / (known + 1) / np.maximum(seen, 1e-300), 1)
            weight = np.where(before > 0, (1 - seen * scale) / np.maximum(1 - below, 1e-300), 1)
            p = np.where(pair > 0, double(pair) / known * scale, weight * alone(count))
            base = np.log10((count + 0.5) / (n_tokens + 0.5 * (n_types + 1)))
            yield pd.DataFrame({
                "doc_id": rows["doc_id"], "train": rows["train"], "n_tokens": tokens.sizes, "n_known": np.add.reduceat((count > 0).astype(np.int64), tokens.begin),
                "train_tokens": n_tokens, "base_score": np.add.reduceat(base, tokens.begin), "score": np.add.reduceat(np.log10(p), tokens.begin)})

    return docs.mapInPandas(judge, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, train boolean, n_tokens long, n_known long, "
                                   "train_tokens long, base_score double, score double")
