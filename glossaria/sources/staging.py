"""Tables written once to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a session in one process, as in tests, gets one of its own when the setting is absent."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _own:
        _own[sc.applicationId] = tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
    return _own[sc.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Writes ``df`` as Parquet and reads it back: cuts the lineage, survives lost executors, and later plans know its size.

    With ``by``, a folder for each value of a column, so that whoever wants one value reads no other rows.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.partitionBy(*([by] if by else [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(spark: SparkSession) -> list[str]:
    """The folders that this session has made and not deleted, in the order they were made."""
    return list(_made.get(spark.sparkContext.applicationId, []))


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Deletes folders of :func:`stage`, for whoever made a result of them and has it written: a DataFrame that reads one fails afterwards."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    made = _made.get(spark.sparkContext.applicationId, [])
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(hadoop).delete(at, True)
        if path in made:
            made.remove(path)
