"""Datasets as they arrive, change and go, and counts that go on over micro-batches.

A batch's tables lie in folders of their own, ``<table>/batch=<name>/Dataset=<name>``. A manifest says for each dataset which
batch has it; a version (:mod:`glossaria.sources.versions`) names the manifest that counts. So all tables of a batch are
there at once or not at all, and what a later batch replaces is no longer named.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from glossaria.operators.quality import TALLIES
from glossaria.plans import corpus
from glossaria.schemas import FORMS_WORKING, LANGUAGES, METADATA, PARAMETERS, REFERENCES, schema_of
from glossaria.sources import files, versions

#: ``batch`` is null for a dataset that something keeps out, and ``reason`` says what.
MANIFEST = "Dataset string, fingerprint string, batch string, reason string"
_SCHEMAS = {
    "forms": schema_of(FORMS_WORKING), "languages": schema_of(LANGUAGES), "parameters": schema_of(PARAMETERS), "metadata": schema_of(METADATA), "references": schema_of(REFERENCES),
    "bibliography": "Dataset string, pos long, key string, text string", "headers": "Dataset string, columns array<string>", "tallies": TALLIES,
}


def manifest(spark: SparkSession, target: str) -> tuple[int, DataFrame]:
    """The version that counts, and its manifest: a row per dataset. Without a version, 0 and no rows."""
    number, name = versions.current(spark, target)
    return number, spark.createDataFrame([], MANIFEST) if name is None else spark.read.schema(MANIFEST).parquet(f"{target}/_manifests/{name}")


def read(spark: SparkSession, target: str) -> corpus.Corpus:
    """The tables of the version that counts; what others have written since, or left unfinished, is not seen."""
    _, named = manifest(spark, target)
    named = named.where("batch is not null").select("batch", "Dataset")
    made = spark.createDataFrame([], "batch string, Dataset string") if named.isEmpty() else named

    def table(name: str) -> DataFrame:
        schema = T.StructType.fromDDL(s) if isinstance(s := _SCHEMAS[name], str) else s
        if made is not named:
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(T.StructType([*schema, T.StructField("batch", T.StringType())])).parquet(f"{target}/{name}")
        return rows.join(made, ["batch", "Dataset"], "left_semi").select(*schema.names)

    return corpus.Corpus(**{name: table(name) for name in _SCHEMAS})


def changes(found: DataFrame, held: DataFrame) -> DataFrame:
    """``Dataset`` and ``change`` (``new``, ``changed``, ``gone`` or ``same``) by the fingerprints of what is there and what is held."""
    both = found.select("Dataset", F.col("fingerprint").alias("now")).join(held.select("Dataset", F.col("fingerprint").alias("before")), "Dataset", "full")
    change = F.when(F.col("before").isNull(), "new").when(F.col("now").isNull(), "gone").when(F.col("now") != F.col("before"), "changed").otherwise("same")
    return both.select("Dataset", change.alias("change"))


def ingest(spark: SparkSession, root: str, target: str, by_content: bool = False) -> int:
    """Brings the tables under ``target`` to what lies under ``root``, and returns their version.

    Datasets that are new or whose files have changed since are built; those that are gone are no longer named. If nothing
    has changed, nothing is done. A batch that fails leaves the version before it; of two that run at once the later one
    fails with :class:`versions.LostRace` and can be run again.
    """
    number, held = manifest(spark, target)
    found = files.fingerprints(spark, root, by_content).cache()
    try:
        told = {r["Dataset"]: r["change"] for r in changes(found, held).collect()}  # names of directories
        names = sorted(d for d, c in told.items() if c in ("new", "changed"))
        if number and set(told.values()) <= {"same"}:
            return number
        batch = f"{number + 1:012d}-{uuid.uuid4().hex[:8]}"
        bad = corpus.write_full(spark, root, lambda table: f"{target}/{table}/batch={batch}", names)[1] if names else []
        why = spark.createDataFrame([(d, f"{n}: {r}") for d, n, r in bad], "Dataset string, reason string").groupBy("Dataset").agg(F.min("reason").alias("reason"))
        built = found.where(F.col("Dataset").isin(names)).join(why, "Dataset", "left").select("Dataset", "fingerprint", F.when(F.col("reason").isNull(), F.lit(batch)).alias("batch"), "reason")
        kept = held.where(F.col("Dataset").isin([d for d, c in told.items() if c == "same"]))
        kept.unionByName(built).coalesce(1).write.parquet(f"{target}/_manifests/{batch}")
        return versions.publish(spark, target, number, batch)
    finally:
        found.unpersist()


def clean(spark: SparkSession, target: str) -> int:
    """Deletes the folders of batches that the version that counts no longer names, and returns how many; batches that come after it stay.

    Readers that began with an earlier version lose their files.
    """
    number, held = manifest(spark, target)
    named = {r["batch"] for r in held.select("batch").distinct().collect()}  # names of batches
    gone = set()
    for table in _SCHEMAS:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/{table}")
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in fs.listStatus(at) if fs.exists(at) else []:
            batch = status.getPath().getName().removeprefix("batch=")
            if batch[:12].isdigit() and int(batch[:12]) <= number and batch not in named:
                fs.delete(status.getPath(), True)
                gone.add(batch)
    return len(gone)


def watch(spark: SparkSession, root: str, target: str, checkpoint: str, every: str = "1 minute", by_content: bool = False) -> StreamingQuery:
    """:func:`ingest` again and again, as the micro-batches of a stream; a batch that loses a race is left to the next one."""

    def look(_: DataFrame, __: int) -> None:
        try:
            ingest(spark, root, target, by_content)
        except versions.LostRace:
            pass

    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
    return ticks.writeStream.foreachBatch(look).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def running_stats(rows: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``n_rows`` and non-null values ``n_<column>`` per group, of a batch or a stream alike."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *(F.count(c).alias(f"n_{c}") for c in cols))


def windowed_stats(rows: DataFrame, time: str, width: str, late: str, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """:func:`running_stats` by tumbling window; rows later than ``late`` behind the newest are left out of a stream."""
    return running_stats(rows.withWatermark(time, late).withColumn("window", F.window(time, width)), ["window", *by], cols)


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1) -> DataFrame:
    """A Parquet folder as a stream of its files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_to_table(stream: DataFrame, target: str, checkpoint: str, mode: str = "complete") -> None:
    """Runs an aggregating stream over what is there and leaves its last result as Parquet under ``target``."""

    def keep(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(target)

    stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def revised_stats(rows: DataFrame, dataset: str, revision: str, cols: Sequence[str]) -> DataFrame:
    """:func:`running_stats` of each dataset's newest revision: rows of older ones count no more. A null revision is the oldest."""
    return _newest(running_stats(rows, [dataset, revision], cols), dataset, revision)


def _newest(counts: DataFrame, dataset: str, revision: str) -> DataFrame:
    newest = counts.groupBy(F.col(dataset).alias("__dataset")).agg(F.max(revision).alias("__revision"))
    return counts.join(newest, F.col(dataset).eqNullSafe(F.col("__dataset")) & F.col(revision).eqNullSafe(F.col("__revision"))).select(*counts.columns)


def merged_stats(held: DataFrame, more: DataFrame, dataset: str, revision: str) -> DataFrame:
    """Counts of two sets of rows as if counted together: of one revision they add up, a newer one takes the place of an older one, in whatever order they come."""
    counts = [c for c in held.columns if c not in (dataset, revision)]
    summed = held.unionByName(more).groupBy(dataset, revision).agg(*(F.sum(c).alias(c) for c in counts))
    return _newest(summed, dataset, revision)


def run_revised(stream: DataFrame, folder: str, checkpoint: str, dataset: str, revision: str, cols: Sequence[str]) -> None:
    """Counts a stream as :func:`revised_stats` does, over whatever is there; :func:`read_revised` gives the result.

    The state has a row per dataset and is a version of ``folder`` after each micro-batch. A micro-batch that is run again
    after its state was stored counts once.
    """

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        version, name = versions.current(spark, folder)
        if name is not None and int(name.split("-")[1]) >= number:
            return
        counts = revised_stats(batch, dataset, revision, cols)
        if name is not None:
            counts = merged_stats(spark.read.schema(counts.schema).parquet(f"{folder}/{name}"), counts, dataset, revision)
        made = f"state-{number}-{uuid.uuid4().hex}"
        counts.write.parquet(f"{folder}/{made}")
        versions.publish(spark, folder, version, made)

    stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read_revised(spark: SparkSession, folder: str) -> DataFrame:
    """The counts of the newest state; an error if there is none."""
    return spark.read.parquet(f"{folder}/{versions.current(spark, folder)[1]}")
