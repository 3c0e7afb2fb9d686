"""Release figures, manifests and the ledger of releases."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaria.functions.figures import archive_name, directory_name, file_key, human_size, version_parts
from glossaria.operators.quality import COVERAGE
from glossaria.sources import versions

SYSTEMS = ("glottolog", "concepticon", "clts")


def version_range(dist: DataFrame, by: Sequence[str] = ("system",)) -> DataFrame:
    """``versions`` of each group: the least and greatest in text order, joined by ``-``; a lone one is itself."""
    low, high = F.min("version"), F.max("version")
    return dist.groupBy(*by).agg(F.when(low == high, low).otherwise(F.concat(low, F.lit("-"), high)).alias("versions"))


def range_of(versions: Column) -> Column:
    """:func:`version_range` of an array of versions; ``unknown`` if it is empty or null."""
    low, high = F.array_min(versions), F.array_max(versions)
    return F.when(F.coalesce(F.size(versions), F.lit(0)) <= 0, "unknown").when(low == high, low).otherwise(F.concat(low, F.lit("-"), high))


def statistics(rolled: DataFrame, versions: DataFrame | None = None, sources: DataFrame | None = None, integrity: DataFrame | None = None) -> DataFrame:
    """The flat record of a release from a one-row roll-up; what is missing is 0, or ``unknown`` for versions.

    ``versions``: system, version, datasets; ``sources``: one row with ``at_signs``; ``integrity``: one row of orphan counts.
    """
    renamed = {"total_datasets": "datasets_count", "total_forms": "forms_count", "total_languages": "languages_count", "total_parameters": "parameters_count", "datasets_with_cognates": "cognates_datasets"}
    shares = dict(zip(COVERAGE.values(), ("glottolog_coverage", "concepticon_coverage", "cognate_coverage", "segments_coverage", "alignment_coverage"), strict=True))
    out = rolled.select(*(F.coalesce(c, F.lit(0)).alias(n) for c, n in renamed.items()), *(F.coalesce(c, F.lit(0.0)).alias(n) for c, n in shares.items()))
    spark = rolled.sparkSession
    none = spark.range(1)
    cited = none.select(F.lit(0).cast("long").alias("sources_entries")) if sources is None else sources.select(F.col("at_signs").alias("sources_entries"))
    orphans = none.select(*(F.lit(0).cast("long").alias(c) for c in ("orphan_languages", "orphan_parameters"))) if integrity is None else integrity.select(F.col("orphan_language_ids").alias("orphan_languages"), F.col("orphan_parameter_ids").alias("orphan_parameters"))
    out = out.join(cited).join(orphans)  # one row each
    if versions is None:
        return out.withColumns({f"{s}_versions": F.lit("unknown") for s in SYSTEMS})
    ranges = version_range(versions).agg(*(F.coalesce(F.max(F.when(F.col("system") == s, F.col("versions"))), F.lit("unknown")).alias(f"{s}_versions") for s in SYSTEMS))
    return out.join(ranges)


def report_statistics(report: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """:func:`statistics` of a stored report, one row of sections; a section or figure that it lacks counts as missing."""
    versions = report.select(F.explode("version_distribution").alias("system", "held")).select("system", F.explode("held").alias("version", "datasets"))
    integrity = report.select(*(F.coalesce(f"referential_integrity.{c}", F.lit(0)).alias(c) for c in ("orphan_language_ids", "orphan_parameter_ids")))
    return statistics(report.select("summary.*", "data_quality.*"), versions, sources, integrity)


def manifest(files: DataFrame, version: str, stem: str = "corpus", expected: Sequence[str] = ()) -> DataFrame:
    """A row per collection and file: key, size, size to read, hash, and names of the archive and its folder.

    ``files``: ``collection``, ``file_name``, ``length``, ``sha256``. Expected files that are not there get ``N/A`` for a
    size. A version that has not two parts is an error.
    """
    v = F.lit(version)
    checked = F.when(version_parts(v).isNull(), F.raise_error(F.lit(f"version {version} is not LETTER.DATE"))).otherwise(v)
    rows = files
    if expected:
        wanted = files.select("collection").distinct().select("collection", F.explode(F.array(*map(F.lit, expected))).alias("file_name"))
        rows = wanted.join(files, ["collection", "file_name"], "left")
    return rows.select(
        checked.alias("version"), "collection", "file_name", file_key(F.col("file_name")).alias("file_key"), F.col("length").alias("size"), F.coalesce(human_size(F.col("length")), F.lit("N/A")).alias("size_shown"),
        "sha256", archive_name(stem, v, F.col("collection")).alias("archive_name"), directory_name(stem, v, F.col("collection")).alias("directory_name"),
    )


def gate(required: DataFrame, found: DataFrame, on: Sequence[str]) -> DataFrame:
    """What is required and not found; a release may go on if there is no row."""
    return required.select(*on).distinct().join(found.select(*on), list(on), "left_anti")


def already_released(ledger: DataFrame, version: str) -> DataFrame:
    return ledger.where(F.col("version") == version)


def ledger_upsert(ledger: DataFrame, rows: DataFrame, force: bool = False, key: Sequence[str] = ("version", "collection", "file_name")) -> DataFrame:
    """The ledger with ``rows`` in place of those of the same key. A version that is there already is an error without ``force``."""
    if not force and not rows.select("version").join(ledger.select("version"), "version", "left_semi").isEmpty():
        raise ValueError("this version has been released; pass force to replace it")
    return ledger.join(rows.select(*key), list(key), "left_anti").unionByName(rows)


#: Columns of the ledger: what :func:`manifest` has.
LEDGER = "version string, collection string, file_name string, file_key string, size long, size_shown string, sha256 string, archive_name string, directory_name string"


def load_ledger(spark: SparkSession, folder: str) -> tuple[int, DataFrame]:
    """The stored ledger's version, to be handed to :func:`save_ledger`, and its rows; 0 and none if nothing is stored."""
    number, name = versions.current(spark, folder)
    return number, spark.createDataFrame([], LEDGER) if name is None else spark.read.schema(LEDGER).parquet(f"{folder}/{name}")


def save_ledger(ledger: DataFrame, folder: str, read: int) -> int:
    """Stores the ledger as the version after ``read``; if another one has been stored since, :class:`versions.LostRace` is raised and nothing changes."""
    name = f"ledger-{uuid.uuid4().hex}"
    ledger.select(*(c.split()[0] for c in LEDGER.split(", "))).coalesce(1).write.parquet(f"{folder}/{name}")  # a row for each released file
    return versions.publish(ledger.sparkSession, folder, read, name)


def record_release(rows: DataFrame, folder: str, force: bool = False) -> int:
    """Puts the rows of a manifest into the stored ledger; a version that it has already is refused without ``force``."""
    read, ledger = load_ledger(rows.sparkSession, folder)
    return save_ledger(ledger_upsert(ledger, rows, force), folder, read)
