"""Token ids as Arrow stream files of equal-length sequences with masks.

Documents are range partitioned by id, so that the files in the order of their part numbers hold them in ascending order. A task
writes one file: record batches of ``rows`` sequences, each a fixed-size list of ``length`` ids and one of as many mask bits. The ids
of one document follow those of the one before without a gap; only the last sequence of a file is filled up, with mask 0. Batches
are not compressed, so that a mapped file gives any sequence without copying.

Null and empty texts have the end id alone. Rows with equal or null ids are all kept (nulls first, then by a hash of the text). No
rows: no file and an empty index. Other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from salescope.llm.common import stored
from salescope.llm.encode import encoder

LENGTH = 2048
ROWS = 256


def stream_schema(length: int, wide: bool) -> pa.Schema:
    ids = pa.uint32() if wide else pa.uint16()
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))])


class SequenceFile:
    """One stream file. ``file[i]`` is sequence ``i`` and its mask, ``ids(start, n)`` a stretch of ids across sequences.

    A file on a local or mounted disk is mapped: both give views of the mapping, but for stretches across batches.
    """

    def __init__(self, uri: str):
        filesystem, path = pa.fs.FileSystem.from_uri(uri)
        source = pa.memory_map(path) if isinstance(filesystem, pa.fs.LocalFileSystem) else filesystem.open_input_file(path)
        self.batches = list(pa.ipc.open_stream(source))
        self.length = self.batches[0].schema.field("ids").type.list_size
        self.rows = len(self.batches[0])

    def __len__(self) -> int:
        return sum(map(len, self.batches))

    def _flat(self, batch: int) -> np.ndarray:
        return self.batches[batch].column("ids").flatten().to_numpy()

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        batch, row = divmod(i, self.rows)
        mask = self.batches[batch].column("mask")[row].values.to_numpy(zero_copy_only=False)  # bits, so they are unpacked
        return self._flat(batch)[row * self.length : (row + 1) * self.length], mask

    def ids(self, start: int, n: int) -> np.ndarray:
        size = self.rows * self.length
        parts = [self._flat(b)[max(0, start - b * size) : start + n - b * size] for b in range(start // size, (start + n - 1) // size + 1)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.zeros(0, np.uint16)])


def write_streams(docs: DataFrame, vocabulary: str, folder: str, end_id: int, length: int = LENGTH, rows: int = ROWS) -> DataFrame:
    """Write ``doc_id, text`` to ``folder``. Returns the index: doc_id, part, file, first (place in the file), n_tokens.

    A file's name holds the attempt of the task that wrote it; the index names the files that count.
    """
    schema = StructType([
        StructField("doc_id", docs.schema["doc_id"].dataType), StructField("part", IntegerType()),
        StructField("file", StringType()), StructField("first", LongType()), StructField("n_tokens", LongType()),
    ])

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary)
        wide = encode.library.get_vocab_size() > 1 << 16
        kind, end = (np.uint32 if wide else np.uint16), np.array([end_id], "<u4").tobytes()
        task, out, sink = TaskContext.get(), None, None
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.arrow"
        layout, size = stream_schema(length, wide), rows * length
        waiting, held, first = [], 0, 0

        def emit(values: np.ndarray, n: int) -> None:
            mask = np.arange(len(values)) < n
            out.write_batch(pa.record_batch([
                pa.FixedSizeListArray.from_arrays(pa.array(values), length),
                pa.FixedSizeListArray.from_arrays(pa.array(mask), length)], schema=layout))

        for batch in batches:
            if out is None:
                filesystem, path = pa.fs.FileSystem.from_uri(folder)
                filesystem.create_dir(path)
                sink = filesystem.open_output_stream(f"{path}/{name}")
                out = pa.ipc.new_stream(sink, layout)
            counts = []
            for ids in encode.encode(batch["text"]):
                values = np.frombuffer(ids + end, "<u4").astype(kind)
                counts.append(len(values))
                waiting.append(values)
                held += len(values)
                if held >= size:
                    flat = np.concatenate(waiting)
                    for at in range(0, held - size + 1, size):
                        emit(flat[at : at + size], size)
                    waiting, held = [flat[held - held % size :]], held % size
            ends = first + np.cumsum(counts)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "part": task.partitionId(), "file": name,
                                "first": ends - counts, "n_tokens": counts})
            first = int(ends[-1]) if counts else first
        if out is not None:
            if held:
                flat = np.concatenate(waiting)
                emit(np.pad(flat, (0, -held % length)), held)
            out.close()
            sink.close()

    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    return stored(ordered.mapInPandas(write, schema), "stream-index")


def with_starts(index: DataFrame) -> DataFrame:
    """The index with ``start``: all ids in earlier documents. One row per file meets in a window."""
    files = index.groupBy("part").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return index.join(files, "part").withColumn("start", F.col("base") + F.col("first")).drop("base")


def read_checksums(index: DataFrame, folder: str) -> DataFrame:
    """Each indexed document's ids read back from the files: unsigned crc32 of them as little-endian 32-bit integers."""
    schema = StructType([*index.schema.fields, StructField("ids_crc32", LongType())])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, file = None, None
        for batch in batches:
            sums = []
            for which, first, n in zip(batch["file"], batch["first"], batch["n_tokens"]):
                if which != name:
                    name, file = which, SequenceFile(f"{folder}/{which}")
                sums.append(zlib.crc32(file.ids(first, n).astype("<u4").tobytes()))
            yield batch.assign(ids_crc32=np.array(sums, np.int64))

    return index.repartition("file").sortWithinPartitions("file", "first").mapInPandas(read, schema)
