"""Parents' columns joined to forms, and keys that don't resolve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_parent(df: DataFrame, parent: DataFrame, fk: str, pk: str, cols: Sequence[str], dataset: str | None = None, has_col: dict[str, Column] | None = None) -> DataFrame:
    """Left join to a parent's columns; rows stay, and multiply only where a parent key repeats.

    Joins on the key, with ``dataset`` on that as well, so that keys of different datasets that read alike don't meet.
    A column that ``df`` has stays as it is, or, with ``has_col``, only where the condition holds. The size of
    the parent decides on a broadcast, so nothing is hinted here.
    """
    has = has_col or {}
    taken = [c for c in cols if c in parent.columns and (c not in df.columns or c in has)]
    right = parent.select(*([F.col(dataset).alias("__dataset")] if dataset else []), F.col(pk).alias("__pk"), *(F.col(c).alias(f"__p_{c}") for c in taken))
    on = F.col(fk) == F.col("__pk")
    if dataset:
        on = on & (F.col(dataset) == F.col("__dataset"))
    joined = df.join(right, on, "left")
    here = lambda c: F.when(has[c], F.col(c)).otherwise(F.col(f"__p_{c}")) if c in df.columns else F.col(f"__p_{c}")
    new = [c for c in taken if c not in df.columns]
    return joined.select(*((here(c) if c in taken else F.col(f"`{c}`")).alias(c) for c in df.columns), *(here(c).alias(c) for c in new))


def orphans(df: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """The distinct non-null keys of ``df`` that no parent has."""
    return df.where(F.col(fk).isNotNull()).select(F.col(fk).alias("key")).distinct().join(parent.select(F.col(pk).alias("key")), "key", "left_anti")


def integrity(forms: DataFrame, languages: DataFrame, parameters: DataFrame) -> DataFrame:
    """One row: distinct orphan keys of each kind, and forms without the parents' columns."""
    n = lambda rows, name: rows.agg(F.count(F.lit(1)).alias(name))
    gaps = forms.agg(F.count_if(F.col("Glottocode").isNull()).alias("forms_without_glottocode"), F.count_if(F.col("Concepticon_ID").isNull()).alias("forms_without_concepticon_id"))
    found = n(orphans(forms, "Language_ID", languages, "ID"), "orphan_language_ids").join(n(orphans(forms, "Parameter_ID", parameters, "ID"), "orphan_parameter_ids"))
    return found.join(gaps)  # one row each


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that several rows have, and ``n_rows``."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
