"""Writers of tables, CSV exports, bibliographies and reports."""

from __future__ import annotations

import csv
import io
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaria.sources.files import COPY_BYTES, part_order


#: A number for each row of what :func:`write_table` deals by sizes; it is not written. Bytes of source files that a task writes the rows of.
DEAL, TASK_BYTES = "_deal", 8 << 20


def write_table(df: DataFrame, path: str, partition_by: str | None = "Dataset", mode: str = "overwrite", sizes: dict[str, int] | None = None) -> None:
    """Parquet, a folder per dataset; only the datasets in ``df`` are replaced, so that a repeated write changes nothing.

    Rows are dealt by dataset and a rebalancing shuffle splits the large ones, but not below its advised size or what one
    task before it gave, and a task sorts all that it writes. With ``sizes``, the bytes of the files that the rows of each
    dataset come from, tasks get even shares of :data:`TASK_BYTES`, by the column ``_deal``.
    """
    if partition_by is None:
        df.write.mode(mode).parquet(path)
        return
    dealt = df.hint("rebalance", partition_by) if sizes is None else _dealt(df, partition_by, sizes)
    dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)


def _dealt(df: DataFrame, by: str, sizes: dict[str, int]) -> DataFrame:
    n, told = places(sizes)
    held = df.sparkSession.createDataFrame(told, "__of string, __first int, __shares int")  # a row for each dataset
    share = F.col("__first") + F.pmod(F.col(DEAL), F.col("__shares")).cast("int")
    placed = df.join(F.broadcast(held), F.col(by) == F.col("__of"), "left").select(*(c for c in df.columns if c != DEAL), F.coalesce(share, F.lit(0)).alias("__task"))
    return placed.repartitionById(n, "__task").drop("__task")


def places(sizes: dict[str, int]) -> tuple[int, list[tuple[str, int, int]]]:
    """How many tasks write what has these sizes, and of each name the first task and the number of tasks: small ones share a task, each large one has some of its own."""
    told, at, filled = [], 0, 0
    for name, size in sorted(sizes.items(), key=lambda x: (x[1], x[0])):
        shares = max(1, -(-size // TASK_BYTES))
        if filled and filled + size > TASK_BYTES:
            at, filled = at + 1, 0
        told.append((name, at, shares))
        at, filled = at + shares - 1, filled + size if shares == 1 else TASK_BYTES
    return at + 1, told


def _shown(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    out = df.select(*columns) if columns else df
    return out.select(*(F.initcap(F.col(c).cast("string")).alias(c) if kind == "boolean" else F.col(c) for c, kind in out.dtypes))


def export_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> tuple[int, str]:
    """One CSV file with a header, the rows in the order of ``df``: null as an empty cell, booleans as ``True`` and ``False``, quotes doubled, white space kept. Returns its length and hash."""
    shown, parts = _shown(df, columns), _parts_of(path)
    shown.write.csv(parts, escape='"', nullValue="", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    header = io.StringIO()
    csv.writer(header, lineterminator="\n").writerow(shown.columns)
    return _joined(df.sparkSession, parts, path, header.getvalue())


def write_report(df: DataFrame, path: str) -> tuple[int, str]:
    """One file of JSON, an object a row; nulls stay visible. Returns its length and hash."""
    parts = _parts_of(path)
    df.write.option("ignoreNullFields", "false").json(parts)
    return _joined(df.sparkSession, parts, path)


def write_bibliography(entries: DataFrame, path: str) -> tuple[int, str]:
    """One file of the entries (``Dataset``, ``pos``, ``text``) in order, a blank line between them. Returns its length and hash."""
    parts = _parts_of(path)
    rows = entries.where(F.col("text").rlike(r"\S")).orderBy("Dataset", "pos").select(F.concat(F.rtrim("text"), F.lit("\n")).alias("value"))
    rows.write.text(parts)
    return _joined(entries.sparkSession, parts, path)


def _parts_of(path: str) -> str:
    """A folder beside the file, for its parts: not read by anyone, for its name begins with an underscore."""
    folder, _, name = path.rpartition("/")
    return f"{folder}/_parts-{name}-{uuid.uuid4().hex}"


def _joined(spark: SparkSession, parts: str, path: str, header: str = "") -> tuple[int, str]:
    """Strings the parts of a folder, in the order of their names, together to a file, which is there once it is whole; the folder goes.

    Bytes run through a buffer of the driver's JVM, and through the digest on the way; nobody holds the file.
    """
    jvm = spark.sparkContext._jvm
    at, draft, final = (jvm.org.apache.hadoop.fs.Path(p) for p in (parts, f"{parts}/_whole", path))
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted((s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("part-")), key=lambda p: part_order(p.getName()))
    digest = jvm.java.security.MessageDigest.getInstance("SHA-256")
    out = jvm.java.security.DigestOutputStream(fs.create(draft, True), digest)
    try:
        out.write(bytearray(header.encode()))
        for part in found:
            stream = fs.open(part)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, COPY_BYTES, False)
            finally:
                stream.close()
    finally:
        out.close()
    length = fs.getFileStatus(draft).getLen()
    fs.delete(final, True)
    fs.rename(draft, final)
    fs.delete(at, True)
    return length, bytes(digest.digest()).hex()


def dry_run(df: DataFrame) -> None:
    """Computes everything and keeps nothing."""
    df.write.format("noop").mode("overwrite").save()
