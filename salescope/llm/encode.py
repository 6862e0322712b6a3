"""Encoding of whole texts with a public tokenizer, piece by piece with a bounded cache.

Both vocabularies merge only inside a stretch without blanks, and a stretch always ends before a blank that follows a non-blank,
and before a comma or full stop that follows a letter or digit. A text may be cut there and each piece encoded by the library on
its own; the ids join to those of the whole text. Words repeat, so a worker encodes most of them once. The strings of special tokens
hold neither blank, comma nor full stop, so they are never cut, and become their ids as the library has it.

A text of any length is encoded whole. Equal pieces, and so equal texts, have equal ids.
"""

from __future__ import annotations

import os
import pickle
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np

CACHE_ENTRIES = 1_500_000
#: Of a cache of more entries only so many, those met again most often, stay when its task ends, as the worker may next do quite
#: other work and holds its memory for good.
KEPT_ENTRIES = 250_000
CHUNK = 500
GROUP_PIECES = 400_000
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
SAFE_CUT = re.compile(r"(?<=[^\W_])(?=[,.])|(?<=\S)(?=\s)")
WORD = re.compile(r" [^\W\d_]+")
_encoders: dict[str, Encoder] = {}


def pieces(text: str) -> list[str]:
    """Cut a text where the tokenizers cut it too."""
    blanks = [c for c in BLANKS if c in text]
    plain = (
        "\0" not in text
        and not any(a + b in text for a in blanks for b in blanks)
        and all(all(map(str.isalnum, [x[-1:] for x in text.split(mark)[:-1]])) for mark in ",.")
    )
    if not plain:
        return SAFE_CUT.split(text)
    return text.replace(",", "\0,").replace(".", "\0.").replace("\n", "\0\n").replace(" ", "\0 ").split("\0")


class Encoder:
    """One vocabulary and what its pieces have been encoded to."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {}
        self.again: Counter[str] = Counter()

    def _learn(self, fresh: set[str]) -> None:
        words = list(filter(WORD.fullmatch, fresh))
        groups = [words[i : i + CHUNK] for i in range(0, len(words), CHUNK)]
        rest = list(fresh.difference(words))
        for group, found in zip(groups, self.library.encode_batch(["".join(g) for g in groups], add_special_tokens=False)):
            counts = np.bincount(np.array(found.word_ids, np.int64), minlength=len(group))
            if len(counts) != len(group):  # a word that the library cuts further
                rest += group
                continue
            ids, ends = np.array(found.ids, "<u4").tobytes(), (np.cumsum(counts) * 4).tolist()
            self.cache.update(zip(group, map(ids.__getitem__, map(slice, [0, *ends], ends))))
        for piece, found in zip(rest, self.library.encode_batch_fast(rest, add_special_tokens=False)):
            self.cache[piece] = np.array(found.ids, "<u4").tobytes()

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; a null or empty text has none."""
        waiting: list[list[str]] = []
        size = 0
        for text in texts:
            waiting.append(pieces(text) if text else [])
            size += len(waiting[-1])
            if size > GROUP_PIECES:
                yield from self._finish(waiting)
                waiting, size = [], 0
        yield from self._finish(waiting)

    def rest(self) -> None:
        """To be called at the end of a task."""
        if len(self.cache) > KEPT_ENTRIES:
            kept = [p for p, _ in self.again.most_common(KEPT_ENTRIES)]
            packed = pickle.dumps([(p, self.cache[p], self.again[p]) for p in kept])  # made anew, so that memory around them is given back
            del kept
            self.cache.clear()
            self.again.clear()
            for piece, ids, times in pickle.loads(packed):
                self.cache[piece], self.again[piece] = ids, times

    def _finish(self, waiting: list[list[str]]) -> list[bytes]:
        met = set().union(*waiting)
        fresh = met.difference(self.cache)
        if len(self.cache) + len(fresh) > CACHE_ENTRIES:
            self.cache.clear()
            self.again.clear()
            fresh = met
        else:
            self.again.update(met.difference(fresh))
        self._learn(fresh)
        return [b"".join(map(self.cache.__getitem__, parts)) for parts in waiting]


def encoder(path: str) -> Encoder:
    """The encoder of this process for a vocabulary file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
