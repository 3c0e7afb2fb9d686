"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaria.sources.staging import stage

__all__ = ["ascii_lower", "bound_batches", "id_and_text", "shuffle_partitions", "stage", "table"]

#: ASCII letters, for lower-casing that leaves all other characters alone.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Bytes of Arrow data that a Python worker gets at once; a longer text comes alone.
ARROW_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's bound on what a Python worker gets at once, so that long texts don't fill its memory.

    For queries and pipeline stages to call; operators leave the caller's settings alone.
    """
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(size).rstrip("bB")) > ARROW_BYTES:
        spark.conf.set(size, f"{ARROW_BYTES}b")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) alone, so that other columns never clash."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions to ask for where a small table is opened into a large one and must not stay in a few tasks."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
