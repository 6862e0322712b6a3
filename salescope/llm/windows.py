"""Removal of words in windows that occur more than once (Rabin-Karp).

A window is ``size`` consecutive words of one document. Its hash is taken from prefix sums of its block; blocks send their distinct
window hashes to buckets, which count the blocks that hold each and answer with one bit. A window is repeated if it occurs twice in
its block or in another block; overlapping repeated windows merge into maximal intervals. A hash is 64 bits, and its bucket comes
from a second, independent hash, so that equality has more bits the larger the input.

Null and empty texts have no words; a text of fewer words than a window loses none. Equal rows repeat each other, so both lose their
windows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from salescope.llm import lookup
from salescope.llm.ragged import BASE_A, BASE_B, Words, covered, stretch_hashes, windows


def _texts(frame: pd.DataFrame) -> list[bytes]:
    return [t.encode() if t else b"" for t in frame["text"]]


def _sent(words: Words, size: int, buckets: int) -> tuple[lookup.Sent, np.ndarray, np.ndarray]:
    values = words.hashes(BASE_A)
    starts, _ = windows(words, size)
    keys = stretch_hashes(values, starts, starts + size, BASE_A)
    spread = stretch_hashes(words.hashes(BASE_B), starts, starts + size, BASE_B) >> np.uint64(20)
    return lookup.sent(keys, spread, buckets), keys, starts


def removed_words(docs: DataFrame, size: int, keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one blank), intervals (from, to) of removed words."""
    dealt, total = lookup.blocks(docs)
    buckets = lookup.buckets_for(total // 6)

    def send(frame: pd.DataFrame) -> pd.DataFrame:
        out, keys, _ = _sent(Words(_texts(frame)), size, buckets)
        block = frame["block"].iloc[0]
        return pd.DataFrame([(block, b, keys[at].tobytes()) for b, at in out.parts], columns=["block", "bucket", "keys"])

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(k, np.uint64) for k in frame["keys"]]
        keys = np.concatenate(parts)
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        shared = np.zeros(len(keys), bool)
        shared[order[1:][same]] = True
        shared[order[:-1][same]] = True
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        return pd.DataFrame({"block": frame["block"], "bucket": frame["bucket"], "n": [len(p) for p in parts],
                             "bits": [np.packbits(x).tobytes() for x in np.split(shared, cuts)]})

    def finish(frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        texts = _texts(frame)
        words = Words(texts)
        out, _, starts = _sent(words, size, buckets)
        answers = answers.sort_values("bucket")
        bits = [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(answers["bits"], answers["n"])]
        shared = np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)
        repeated = out.spread(shared | (out.counts() > 1))
        lost = covered(starts[repeated], size, len(words.starts))
        rows = []
        for doc, text, a, b in zip(frame["doc_id"], texts, words.first, words.last):
            gone = lost[a:b]
            n = int(gone.sum())
            own = text.split()
            kept = b" ".join(compress(own, (~gone).tolist()) if n else own)
            edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))).reshape(-1, 2).tolist() if n else []
            rows.append((doc, int(b - a), n, hashlib.sha256(kept).hexdigest(), edges, kept.decode() if keep_text else None))
        return pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "intervals", "kept_text"])

    messages = dealt.groupBy("block").applyInPandas(send, "block int, bucket int, keys binary")
    answers = lookup.bucketed(messages, merge, "block int, bucket int, n int, bits binary")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_removed long, kept_sha256 string, intervals array<array<int>>, kept_text string"
    found = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(finish, schema)
    return found if keep_text else found.drop("kept_text")
