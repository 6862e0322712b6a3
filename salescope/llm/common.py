"""Tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from salescope.session import scratch_path


def stored(df: DataFrame, name: str = "table", codec: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: later steps don't replay it when an executor is lost.

    ``codec`` compresses it otherwise than the session says.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)
