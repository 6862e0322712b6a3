"""A training-data pipeline: language, near copies, benchmark passages, personal data, packing.

Each stage works on all rows its predecessor kept and, but for the last, returns the columns of ``documents``. Null texts, ids, labels
and equal rows are handled as the stage's operator says; an empty table passes through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm import language, packing, pieces, pii, simhash, winnowing
from salescope.llm.common import stored

#: A document whose strongest language has less than this share is of no language.
LEAST_SHARE = 0.4
#: Near copies: SimHash of three-word shingles, linked at three or fewer differing bits.
SHINGLE, RADIUS = 3, 3


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID (3), learned from the labelled documents: those without a letter or a dominant language go."""
    found = language.identify(docs.select("text", F.struct("*").alias("row")), docs)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)).select("row.*")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash (2): the document with the least id of each component stays (null ids last, then the first row)."""
    held = stored(docs.select(F.monotonically_increasing_id().alias("place"), F.struct("*").alias("row")), "held")
    found = simhash.near_duplicates(held.select(F.col("place").alias("doc_id"), F.col("row.text").alias("text")), SHINGLE, RADIUS)
    ids = held.select("place", F.col("row.doc_id").isNull().alias("missing"), F.col("row.doc_id").alias("doc_id"))
    placed = found.select(F.col("doc_id").alias("place"), "component_id").join(ids, "place")
    first = placed.groupBy("component_id").agg(F.min(F.struct("missing", "doc_id", "place")).alias("first"))
    return held.join(first.select("first.place"), "place", "left_semi").select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Winnowing (5): documents that hold a window of a benchmark item go."""
    found = winnowing.contamination(docs.select("text", F.struct("*").alias("row")), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(~F.col("contaminated")).select("row.*")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data (9): each span gives way to the name of its kind."""
    return pii.redact(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing (4) of all that is left into sequences of 4096 tokens."""
    cut = pieces.encoded_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), 4096, end_id=1)
    return packing.pack(cut, "length", 4096, ["doc_id", "piece"])


STAGES = [
    ("language", keep_known_language),
    ("near_copies", keep_one_of_near_copies),
    ("benchmark", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack_documents),
]
#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
