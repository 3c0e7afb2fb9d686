"""The corpus pipeline: four stages from ``documents`` to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept; all but the last return the
columns of ``documents``. A stage's result has to be written before the next one is called.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaria.llm.common import bound_batches, table
from glossaria.llm.line_dedup import remove_boilerplate
from glossaria.llm.packing import pack_documents
from glossaria.llm.quality_rules import keep_good
from glossaria.llm.simhash_texts import drop_similar_texts
from glossaria.sources import staging


#: Folders that the latest stage of each session and input made on its way to its result.
_on_the_way: dict[tuple[str, str], list[str]] = {}


def _stage(apply):
    """A stage that first deletes what the stage before it, of the same session and input, made on its way: that one's result has been written by then."""

    @wraps(apply)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        key = spark.sparkContext.applicationId, sf_dir
        staging.delete(spark, _on_the_way.pop(key, []))
        before = staging.staged(spark)
        bound_batches(spark)
        out = apply(spark, docs, sf_dir)
        _on_the_way[key] = [p for p in staging.staged(spark) if p not in before]
        return out

    return run


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sites go; ``n_chars`` follows the text. A document that loses all its words goes too."""
    cleaned = remove_boilerplate(docs)
    changed = F.col("n_removed") > 0
    out = cleaned.where(~changed | F.col("text").rlike(r"[^ \t-\r]")).withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8) stays, the one with the smallest id."""
    return drop_similar_texts(docs)


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its place in a training sequence."""
    return pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("quality_rules", quality), ("line_dedup", line_dedup), ("simhash_near_dedup", near_dedup), ("best_fit_packing", packing)]

#: SQL can't express the model of the quality rules, XXH64 and the tokenizer; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next one reads it and deleted after that."""
    docs, read = table(spark, sf_dir, "documents"), []
    for name, apply in STAGES[:-1]:
        docs = staging.stage(apply(spark, docs, sf_dir), name)
        staging.delete(spark, read)
        read = staging.staged(spark)[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
