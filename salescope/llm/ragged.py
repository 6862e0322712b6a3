"""Blocks of documents as flat numpy arrays: words, and polynomial (Rabin-Karp) hashes of stretches of bytes or words.

A hash is a sum of value times power of an odd base, modulo 2**64; the base has an inverse, so that any stretch's hash comes from
two prefix sums. Values of bytes and of words are mixed 64-bit numbers, so that sums do not cancel by pattern.
"""

from __future__ import annotations

import numpy as np

BASE_A, BASE_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x + BASE_A
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(256, dtype=np.uint64))


_powers: dict[int, np.ndarray] = {}
CHUNK = 1 << 20


def powers(base: np.uint64, n: int) -> np.ndarray:
    """The first n powers, kept for the next call."""
    held = _powers.get(int(base))
    if held is None or len(held) < n:
        held = np.full(max(n, CHUNK + 1), base, np.uint64)
        held[0] = 1
        np.multiply.accumulate(held, out=held)
        _powers[int(base)] = held
    return held[:n]


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def stretch_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hash of each values[start:end], wherever it stands."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    return (sums[ends] - sums[starts]) * powers(inverse(base), len(values) + 1)[starts]


class Words:
    """The words of many texts, laid out one after the other.

    ``starts``/``ends`` are places in ``data``; ``first``/``last`` the range of words of each text.
    """

    def __init__(self, texts: list[bytes]):
        self.data = b"\n".join(texts) + b"\n"
        raw = np.frombuffer(self.data, np.uint8)
        blank = BLANK[raw]
        word = ~blank
        before = np.concatenate(([True], blank[:-1]))
        self.starts = np.flatnonzero(word & before)
        self.ends = np.flatnonzero(blank & ~np.concatenate(([True], blank[:-1])))
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        self.last = np.searchsorted(self.starts, text_ends)
        self.first = np.concatenate(([0], self.last[:-1])).astype(np.int64)
        self.raw = raw

    def hashes(self, base: np.uint64 = BASE_A) -> np.ndarray:
        """A mixed hash of each word's bytes and length."""
        out = np.empty(len(self.starts), np.uint64)
        at = 0
        while at < len(out):  # a chunk of bytes at a time, a longer word alone
            to = max(at + 1, int(np.searchsorted(self.ends, self.starts[at] + CHUNK, side="right")))
            begin = self.starts[at]
            sums = stretch_hashes(BYTE_VALUES[self.raw[begin : self.ends[to - 1]]], self.starts[at:to] - begin, self.ends[at:to] - begin, base)
            out[at:to] = mix(sums + (self.ends[at:to] - self.starts[at:to]).astype(np.uint64))
            at = to
        return out


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of each run of ``size`` words inside one text, and the text it is in."""
    n = np.maximum(words.last - words.first - size + 1, 0)
    text = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + words.first[text], text


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n places lie in a stretch [start, start + size)."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + size, -1)
    return np.cumsum(steps[:-1]) > 0
