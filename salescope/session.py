"""Session settings and durable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "salescope", **conf: str) -> SparkSession:
    """Session with adaptive execution and skew handling on; ``conf`` overrides (dots as ``__``)."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach. Only a local master may fall back to a machine-local one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    local = tempfile.mkdtemp(prefix="salescope-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, never reused between calls."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in reliable storage so that a lost executor does not replay a loop."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def fixed_and_spread(df: DataFrame, task_rows: int = 0) -> DataFrame:
    """Materialise ``df``; a small table that landed in fewer partitions than there are cores is dealt out again.

    With ``task_rows`` a table gets no more partitions than it has that many rows.
    """
    fixed = cut_lineage(df)
    parts = df.sparkSession.sparkContext.defaultParallelism
    if task_rows:
        parts = min(parts, -(-fixed.count() // task_rows))
    return fixed if fixed.rdd.getNumPartitions() >= parts else cut_lineage(fixed.repartition(parts))


def stored(df: DataFrame) -> DataFrame:
    """``df`` in the shared folder as columns, for passes that each read some of its columns or rows.

    They are neither packed nor coded, so that a task's share of the bytes is a bounded number of rows.
    """
    path = scratch_path(df.sparkSession, "columns")
    plain = {"compression": "uncompressed", "parquet.enable.dictionary": "false", "parquet.block.size": str(1 << 24)}
    df.write.options(**plain).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Tables counted to hold more rows are never sent whole to every task.
SENT_ROWS = 20_000


def unsent(df: DataFrame, rows: int) -> DataFrame:
    """``df`` for a join on its rows: of more than ``SENT_ROWS`` both sides are sorted and merged, whatever size Spark guesses.

    Guesses start from the bytes of packed files and are often a small part of what the rows take in memory; a broadcast by them
    goes through the driver.
    """
    return df.hint("merge") if rows > SENT_ROWS else df
