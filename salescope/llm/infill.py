"""Fill-in-the-middle: texts cut at two code points and their parts put in another order behind marks.

The cuts are found on whole words of eight bytes (SWAR). The UTF-8 bytes of many texts, one after the other as Arrow holds them, are
viewed as 64-bit integers. A byte is a continuation if bit 7 is set and bit 6 is not; a byte ends a unit (a code point) if no
continuation follows it, which is one shift of the continuation marks, with the next word's first mark carried in. ``bitwise_count``
gives the units that end in each word, and a running sum over words the units that end before it. The place after the k-th unit is in
the word that a binary search of the running sums names; inside it, a product with 0x0101.. turns the marks into running counts in
each byte, and a comparison of all eight bytes at once says how many lie before the one sought.

What a document becomes depends on its id alone (``draws``). Null texts are empty texts, which stay plain; a null id draws as an empty
string. Equal rows become equal rows. A text of any length is cut as a whole; texts are worked on in stretches of about ``STRETCH``
bytes or one text, whichever is more. No rows give no rows; columns but doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

STRETCH = 8 << 20
#: Marks before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
ONES, HIGH = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)


class Units:
    """Places of unit ends in UTF-8 bytes; texts may follow one another without a gap."""

    def __init__(self, data: np.ndarray):
        padded = np.zeros((len(data) // 8 + 2) * 8, np.uint8)
        padded[: len(data)] = data
        words = padded.view("<u8")
        follows = (words >> np.uint64(7)) & ~(words >> np.uint64(6)) & ONES
        after = follows >> np.uint64(8)
        after[:-1] |= follows[1:] << np.uint64(56)
        self.ends = ~after & ONES
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.ends), dtype=np.int64)])

    def rank(self, place: np.ndarray) -> np.ndarray:
        """Units that end before a byte."""
        word = place >> 3
        below = (np.uint64(1) << (np.uint64(8) * (place & 7).astype(np.uint64))) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.ends[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte after the ``k``-th unit, from 1."""
        word = np.searchsorted(self.before, k, "left") - 1
        left = (k - self.before[word] - 1).astype(np.uint64)
        running = self.ends[word] * ONES
        fewer = ((left * ONES | HIGH) - running) & HIGH
        return word * 8 + np.bitwise_count(fewer) + 1


def cut_places(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each text: its units, the lesser and the greater cut in units, and both in bytes. Two draws choose the cuts."""
    units = Units(data)
    base = units.rank(starts)
    n = units.rank(ends) - base
    one, two = first % (n + 1), second % (n + 1)
    low, high = np.minimum(one, two), np.maximum(one, two)
    places = [np.where(cut > 0, units.select(np.maximum(base + cut, 1)), starts) for cut in (low, high)]
    return n, low, high, *places


def check_marks(marks: tuple[str, str, str]) -> None:
    """Refuse marks that could stand across the border of a mark and a text, or that hold one another."""
    for a in marks:
        for b in marks:
            if (a != b and a in b) or any(a.endswith(b[:i]) for i in range(1, min(len(a), len(b)))) or not a:
                raise ValueError(f"marks {marks} may be found where they were not put")
    if len(set(marks)) < 3:
        raise ValueError("three different marks are needed")


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of a document: the first digits of a digest of the seed and its id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output of each document.

    Of 100 documents those drawn ``plain_from`` on stay plain, and of the others those drawn below ``spm_below`` put the suffix first.
    A text that is empty or holds a mark stays plain.
    """
    check_marks(marks)
    p, s, m = (mark.encode() for mark in marks)
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("n", LongType()), StructField("form", StringType()),
                         StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()), StructField("output", StringType())])

    def one(ids: pa.Array, texts: pa.Array, drawn: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
        wide = pa.types.is_large_string(texts.type)
        _, offsets, values = texts.buffers()
        places = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(values, np.uint8)[places[0] : places[-1]] if values is not None else np.zeros(0, np.uint8)
        starts, ends = places[:-1] - places[0], places[1:] - places[0]
        n, low, high, left, right = cut_places(data, starts, ends, drawn[0], drawn[1])
        held = np.zeros(len(texts), bool)
        for mark in marks:
            held |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        plain = (n == 0) | held | (drawn[2] % 100 >= plain_from)
        first = drawn[3] % 100 < spm_below
        raw, out = data.tobytes(), []
        for a, x, y, b, stays, suffix_first in zip(starts.tolist(), left.tolist(), right.tolist(), ends.tolist(), plain.tolist(), first.tolist()):
            if stays:
                out.append(raw[a:b])
            elif suffix_first:
                out.append(b"".join((s, raw[y:b], p, raw[a:x], m, raw[x:y])))
            else:
                out.append(b"".join((p, raw[a:x], s, raw[y:b], m, raw[x:y])))
        form = np.where(plain, "plain", np.where(first, "spm", "psm"))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(n), pa.array(form.tolist()), pa.array(low, mask=plain), pa.array(high - low, mask=plain),
             pa.array(out, texts.type)], names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < len(texts):
                done = sizes[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, done + STRETCH, "right")))
                yield one(batch.column("doc_id")[at:to], texts[at:to], [batch.column(f"h{i}")[at:to].to_numpy(zero_copy_only=False) for i in range(4)], schema.names)
                at = to

    drawn = [h.alias(f"h{i}") for i, h in enumerate(draws(F.col("doc_id"), seed))]
    return docs.select("doc_id", "text", *drawn).mapInArrow(cut, schema)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``transform`` was given."""
    parts = F.split(output, "|".join(re.escape(mark) for mark in marks), -1)
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)
