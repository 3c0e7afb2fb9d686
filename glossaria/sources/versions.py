"""Numbered versions of what a folder holds; the newest one counts.

A version is a small file in ``_versions`` that names what belongs to it. It is put there last, under its number, if nobody
has put one there before: a reader sees all of a version or nothing of it, and of two writers that began with the same
version one fails. File systems that rename by a check and a move, as local ones do, leave a moment in which both may pass.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class LostRace(RuntimeError):
    """Another writer has made the next version since this one read."""


def _at(spark: SparkSession, path: str):
    made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return made, made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current(spark: SparkSession, folder: str) -> tuple[int, str | None]:
    """The newest version's number and what it names; 0 and nothing if there is none."""
    path, fs = _at(spark, f"{folder}/_versions")
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    numbers = [int(n) for n in names if n.isdigit()]
    if not numbers:
        return 0, None
    path, fs = _at(spark, f"{folder}/_versions/{max(numbers):012d}")
    stream = fs.open(path)
    try:
        return max(numbers), bytes(stream.readNBytes(1 << 16)).decode()
    finally:
        stream.close()


def publish(spark: SparkSession, folder: str, read: int, name: str) -> int:
    """Makes the version after ``read``, which names ``name``; raises :class:`LostRace` if it is there already."""
    jvm = spark.sparkContext._jvm
    draft, fs = _at(spark, f"{folder}/_versions/_draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(name.encode()))
    stream.close()
    final, _ = _at(spark, f"{folder}/_versions/{read + 1:012d}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(draft, final, spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
    except Exception as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" not in str(e):
            raise
        raise LostRace(f"version {read + 1} of {folder} has been made by another writer") from e
    return read + 1
