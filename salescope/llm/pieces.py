"""Documents cut into pieces of at most a sequence's capacity."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from salescope.llm.encode import encoder


def encoded_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, little-endian unsigned 32-bit) of each piece.

    A document is its text's ids and ``end_id``; only one longer than ``capacity`` is cut. Null and empty texts are the end id alone;
    equal rows give equal pieces; other columns are not read.
    """
    fields = [StructField("doc_id", docs.schema["doc_id"].dataType), StructField("piece", IntegerType()), StructField("start", LongType()),
              StructField("length", LongType()), StructField("ids_crc32", LongType())]
    schema = StructType(fields + [StructField("ids", BinaryType())] * keep_ids)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc, ids in zip(batch["doc_id"], encode.encode(batch["text"])):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part), part)[: len(schema)])
            yield pd.DataFrame(rows, columns=schema.names)
        encode.rest()

    return docs.select("doc_id", "text").mapInPandas(cut, schema)
