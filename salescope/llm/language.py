"""Language identification by multilingual mixtures.

Each language has a distribution over hashed character n-grams (one to three characters inside words, with the word's borders),
counted over all labelled training texts. A document is a mixture of languages: expectation-maximisation estimates its proportions
from the likelihoods of its n-grams. Nested sets of its strongest languages are fitted one after the other, and the set with the best
log-likelihood less half a logarithm of the number of n-grams for each language is chosen. The prediction is the language with the
greatest share in the chosen set, and the score is that share.

A null text, or one without a letter, is ``und`` with score 0; so is every text if there is no labelled text to learn from. Null labels
are not learned from. Equal rows get equal answers; likelihood ties go to the language first in order. Other columns are not read.

The model has ``FEATURES`` numbers for each language, whatever the input's size; it goes to the tasks with their code.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.ragged import mix

FEATURES = 1 << 16
LARGEST_SET, STEPS = 3, 12
CHUNK_CHARS = 1 << 16


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the lower-cased letters, with one zero for each stretch of anything else, and the end of each text."""
    flat = np.frombuffer("\0".join([*texts, ""]).lower().encode("utf-32-le"), np.uint32)
    letter = (flat >= 0x61) & (flat <= 0x7A)
    other = np.flatnonzero(flat >= 0x80)
    if len(other):
        codes, place = np.unique(flat[other], return_inverse=True)
        letter[other] = np.array([chr(c).isalpha() for c in codes])[place]
    keep = letter | np.concatenate(([True], letter[:-1])) | (flat == 0)
    return np.where(letter, flat, 0)[keep], np.cumsum(flat == 0)[keep] - (flat == 0)[keep]


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts and the text that each is from."""
    codes, text = _letters(texts)
    codes = codes.astype(np.uint64)
    out, of = [], []
    for n in (1, 2, 3):
        if len(codes) < n:
            continue
        key = np.full(len(codes) - n + 1, n, np.uint64)
        inside = np.ones(len(key), bool)
        for j in range(n):
            part = codes[j : len(codes) - n + 1 + j]
            key = key * np.uint64(0x110000) + part
            if 0 < j < n - 1 or n == 1:
                inside &= part > 0
        if n == 2:
            inside &= (codes[:-1] > 0) | (codes[1:] > 0)
        inside &= text[: len(key)] == text[n - 1 :]
        out.append((mix(key[inside]) & np.uint64(FEATURES - 1)).astype(np.int64))
        of.append(text[: len(key)][inside])
    return (np.concatenate(out), np.concatenate(of)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _chunks(texts: list[str]) -> Iterator[list[int]]:
    group, size = [], 0
    for i, text in enumerate(texts):
        group.append(i)
        size += len(text)
        if size >= CHUNK_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def learn(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and the log probability of each feature in each, from ``text, lang``. One row per language and feature comes back."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                texts = part["text"].tolist()
                for group in _chunks(texts):
                    found = np.bincount(features([texts[i] for i in group])[0], minlength=FEATURES)
                    sums[lang] = sums.get(lang, 0) + found
        for lang, found in sums.items():
            used = np.flatnonzero(found)
            yield pd.DataFrame({"lang": lang, "feature": used, "n": found[used]})

    counted = labelled.where("text is not null and lang is not null").select("text", "lang").mapInPandas(count, "lang string, feature long, n long")
    counted = counted.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counted["lang"].unique())
    table = np.full((FEATURES, len(langs)), 0.5)
    table[counted["feature"], np.searchsorted(langs, counted["lang"].astype(str)) if langs else []] += counted["n"]
    return langs, np.log(table / table.sum(0)).astype(np.float32)


def mixtures(counts: np.ndarray, text: np.ndarray, logp: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Best language of each text and its share; rows of ``logp`` belong to ``counts`` occurrences in ``text`` (in order)."""
    k = logp.shape[1]
    begins = np.searchsorted(text, np.arange(n_texts))
    some = np.flatnonzero(np.diff(np.append(begins, len(text))))
    at = begins[some]
    row = np.searchsorted(some, text)
    total = np.add.reduceat(counts, at)
    logp = np.ascontiguousarray(logp.T)  # a row for each language
    top = logp.max(0)
    p = np.exp(logp - top)
    base = np.add.reduceat(counts * top, at)

    def fit(share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """EM from ``share``; a share of 0 stays 0."""
        for _ in range(STEPS):
            part = p * share[:, row]
            part *= counts / np.maximum(part.sum(0), 1e-30)
            share = np.add.reduceat(part, at, axis=1) / total
        fitted = np.log(np.maximum((p * share[:, row]).sum(0), 1e-30))
        return share, base + np.add.reduceat(counts * fitted, at)

    alone = np.add.reduceat(counts * logp, at, axis=1)
    best = np.eye(k)[:, alone.argmax(0)]
    score = alone.max(0) - 0.5 * np.log(total)
    if k > 1:
        full, _ = fit(np.full((k, len(some)), 1 / k))
        rank = np.argsort(np.argsort(-full, axis=0, kind="stable"), axis=0)
        for size in range(2, min(k, LARGEST_SET) + 1):
            allowed = np.where(rank < size, np.maximum(full, 1e-3), 0)
            share, likelihood = fit(allowed / allowed.sum(0))
            likelihood = likelihood - 0.5 * size * np.log(total)
            better = likelihood > score
            best[:, better], score[better] = share[:, better], likelihood[better]
    lang, share = np.full(n_texts, -1), np.zeros(n_texts)
    lang[some], share[some] = best.argmax(0), best.max(0)
    return lang, np.clip(share, 0, 1)


def predict(docs: DataFrame, langs: list[str], logp: np.ndarray) -> DataFrame:
    """``docs`` columns with lang_pred and score, from the text alone."""
    def guess(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in series:
            texts = [t or "" for t in batch]
            names, scores = np.full(len(texts), "und", object), np.zeros(len(texts))
            for group in _chunks(texts):
                found, text = features([texts[i] for i in group])
                if not len(found) or not langs:
                    continue
                key, counts = np.unique(text * FEATURES + found, return_counts=True)
                lang, share = mixtures(counts.astype(np.float32), key // FEATURES, logp[key % FEATURES], len(group))
                known = np.flatnonzero(lang >= 0)
                names[np.array(group)[known]] = np.array(langs, object)[lang[known]]
                scores[np.array(group)[known]] = share[known]
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    udf = F.pandas_udf(guess, "lang_pred string, score double")
    found = docs.withColumn("_found", udf(F.col("text")))
    return found.select(*docs.columns, F.col("_found.lang_pred").alias("lang_pred"), F.col("_found.score").alias("score"))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def identify(docs: DataFrame, training: DataFrame) -> DataFrame:
    return predict(docs, *learn(training))
