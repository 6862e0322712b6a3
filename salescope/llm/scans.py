"""Several passes over one stable scan of documents, with answers waiting for each of its partitions.

A partition's rows are cut, in their order, into blocks of a few MB. What a pass learns for a block is written to the shared folder
in a table partitioned by the scan's partition, and the next pass over the same scan reads its own part of it there. Texts are so
never shuffled. The scan must give the same partitions each time, as one of Parquet files does; each block's row count is
checked against that of the pass before.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark import TaskContext
from pyspark.sql import DataFrame

from salescope.session import scratch_path

BLOCK_CHARS = 8 << 20


def cut(batches: Iterator[pd.DataFrame], size: int = BLOCK_CHARS) -> Iterator[tuple[int, int, pd.DataFrame]]:
    """(partition, block, rows) of this task's rows."""
    part, block, held, chars = TaskContext.get().partitionId(), 0, [], 0
    for batch in batches:
        begin = 0
        for i, n in enumerate(batch["text"].str.len().fillna(0)):
            chars += n
            if chars >= size:
                yield part, block, pd.concat([*held, batch.iloc[begin : i + 1]], ignore_index=True)
                block, held, chars, begin = block + 1, [], 0, i + 1
        if begin < len(batch):
            held.append(batch.iloc[begin:])
    if held:
        yield part, block, pd.concat(held, ignore_index=True)


def kept_by_part(answers: DataFrame, name: str) -> str:
    """Write ``answers`` by their ``part``; returns the folder."""
    path = scratch_path(answers.sparkSession, name)
    answers.repartition("part").write.partitionBy("part").parquet(path)
    return path


def for_part(path: str, part: int, columns: list[str]) -> pd.DataFrame:
    """What waits for a partition."""
    filesystem, root = pa.fs.FileSystem.from_uri(path)
    found = filesystem.get_file_info(pa.fs.FileSelector(f"{root}/part={part}", allow_not_found=True))
    files = [f.path for f in found if f.base_name.endswith(".parquet")]
    tables = [pa.parquet.ParquetFile(filesystem.open_input_file(f)).read(columns).to_pandas() for f in files]
    return pd.concat(tables, ignore_index=True) if tables else pd.DataFrame(columns=columns)
