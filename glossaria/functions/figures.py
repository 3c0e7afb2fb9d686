"""Percentages, sizes, versions and hashes for reports and releases."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = ("B", "KB", "MB", "GB")


def percentage(part: Column, whole: Column, digits: int, of_nothing: float | None = 0.0) -> Column:
    """``100 * part / whole``, halves rounded to the even digit; ``of_nothing`` where ``whole`` is 0."""
    scale = float(10**digits)
    return F.when(whole != 0, F.rint(100 * part.cast("double") / whole * scale) / scale).otherwise(F.lit(of_nothing).cast("double"))


def human_size(size: Column) -> Column:
    """``527 MB``: by 1024, whole numbers with halves to even, one decimal from a terabyte on; null without a size."""
    x = size.cast("double")
    out = F.concat(F.format_string("%.1f", F.rint(x / 1024.0**4 * 10) / 10), F.lit(" TB"))
    for k, unit in reversed(list(enumerate(UNITS))):
        out = F.when(x < 1024.0 ** (k + 1), F.concat(F.format_string("%d", F.rint(x / 1024.0**k).cast("long")), F.lit(f" {unit}"))).otherwise(out)
    return F.when(size.isNotNull(), out)


def thousands(n: Column) -> Column:
    """``2,915,515``."""
    return F.format_number(n, 0)


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def file_key(name: Column) -> Column:
    return F.replace(name, F.lit("."), F.lit("_"))


def version_parts(version: Column) -> Column:
    """``letter`` and ``date`` of ``A.20251008``; null unless there are exactly two parts."""
    parts = F.split(version, r"\.")
    return F.when(F.size(parts) == 2, F.struct(parts[0].alias("letter"), parts[1].alias("date")))


def archive_name(stem: str, version: Column, collection: Column) -> Column:
    v = version_parts(version)
    return F.concat_ws(".", F.lit(stem), v["letter"], collection, v["date"], F.lit("zip"))


def directory_name(stem: str, version: Column, collection: Column) -> Column:
    v = version_parts(version)
    return F.concat_ws("-", F.lit(stem), v["letter"], collection, v["date"])


def release_label(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")
