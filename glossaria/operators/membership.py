"""Collections: subsets of the datasets that a registry names."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Collections and the registry flag of each; ``full`` takes every dataset that is there.
COLLECTIONS = {"full": None, "core": "is_core", "corecog": "is_corecog"}


def members(df: DataFrame, registry: DataFrame, flag: str | None, dataset: str = "Dataset", name: str = "name") -> DataFrame:
    """Rows of the datasets with the flag; all rows without one. The registry is a list of datasets and not of rows."""
    if flag is None:
        return df
    return df.join(registry.where(flag).select(F.col(name).alias(dataset)), dataset, "left_semi")


def explode_memberships(df: DataFrame, registry: DataFrame, flags: dict[str, str | None] = COLLECTIONS, dataset: str = "Dataset", name: str = "name") -> DataFrame:
    """Each row once for every collection that it is in, named by ``collection``; one pass over ``df``."""
    flagged = registry.groupBy(F.col(name).alias(dataset)).agg(*(F.max(f).alias(f"__{c}") for c, f in flags.items() if f))
    joined = df.join(flagged, dataset, "left")
    names = F.array_compact(F.array(*(F.lit(c) if f is None else F.when(F.col(f"__{c}"), F.lit(c)) for c, f in flags.items())))
    return joined.withColumn("collection", F.explode(names)).select(*df.columns, "collection")


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows of all tables by column name; missing columns are null, repeats stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def registry_counts(registry: DataFrame) -> DataFrame:
    return registry.agg(F.count(F.lit(1)).alias("registered"), F.count_if("is_core").alias("core"), F.count_if("is_corecog").alias("corecog"))


def compare(rollups: DataFrame, measures: Sequence[str], collections: Sequence[str] = tuple(COLLECTIONS)) -> DataFrame:
    """A row per measure and a column per collection, from a row per collection."""
    tall = rollups.unpivot("collection", list(measures), "metric", "value")
    return tall.groupBy("metric").pivot("collection", list(collections)).agg(F.first("value"))
