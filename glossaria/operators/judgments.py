"""Judgments (which forms are related) gathered to their forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossaria.functions.text import combine, empty_to_null


def aggregate(df: DataFrame, key: Sequence[str], order: Sequence[str], concat_cols: dict[str, str], first_cols: dict[str, str], sep: str = ";", more: dict[str, Column] | None = None) -> DataFrame:
    """A row per key: lists of ``concat_cols``, first values of ``first_cols`` (input name to output name), and ``more`` aggregates by name.

    A list has the non-null values in the order of ``order``, repeats kept, joined; it is empty without one. First values
    are the first that are not null, so columns may take theirs from different rows. ``order`` must tell the rows of a key
    apart, or ties are broken by the values. One shuffle, on the key, of plain rows, since lists gathered before it would not
    be smaller; then one sorted list a key, from which all columns are taken.
    """
    cells = {c: f"v{k}" for k, c in enumerate(dict.fromkeys([*concat_cols, *first_cols]))}
    row = F.struct(*(F.col(c).alias(f"o{k}") for k, c in enumerate(order)), *(F.col(c).alias(v) for c, v in cells.items()))
    more = more or {}
    gathered = df.repartition(*key).groupBy(*key).agg(F.sort_array(F.collect_list(row)).alias("__rows"), *(m.alias(c) for c, m in more.items()))
    filled = lambda c: F.array_compact(F.col("__rows")[cells[c]])
    lists = (F.array_join(filled(c).cast("array<string>"), sep).alias(out) for c, out in concat_cols.items())
    return gathered.select(*key, *lists, *(F.get(filled(c), F.lit(0)).alias(out) for c, out in first_cols.items()), *more)


def attach(forms: DataFrame, gathered: DataFrame, on: Sequence[str], has_col: dict[str, Column] | None = None) -> DataFrame:
    """Left join that loses no form. Of a column in both tables the left one wins, nulls included.

    With ``has_col`` (column to a condition on ``forms``), the left one wins only where the condition holds: after a
    union over files, whether a file had the column is told by its header and not by nulls.
    """
    clash = [c for c in gathered.columns if c in forms.columns and c not in on]
    has = has_col or {}
    right = gathered.withColumnsRenamed({c: f"__right_{c}" for c in clash if c in has}).drop(*(c for c in clash if c not in has))
    out = forms.join(right, list(on), "left")
    picked = {c: F.when(has[c], F.col(c)).otherwise(F.col(f"__right_{c}")) for c in clash if c in has}
    return out.withColumns(picked).drop(*(f"__right_{c}" for c in picked)).select(*forms.columns, *(c for c in right.columns if c not in on and not c.startswith("__right_")))


def cognacy(own: Column, gathered: Column) -> Column:
    """The form's own judgments, then those of the file."""
    return combine(own, empty_to_null(gathered))


def multiplicity(judged: DataFrame, key: Sequence[str], vary_cols: Sequence[str]) -> DataFrame:
    """Per key: ``n_judgments``, the distinct values ``n_<column>`` of each column, and ``varies``: whether one has several."""
    counted = judged.groupBy(*key).agg(F.count(F.lit(1)).alias("n_judgments"), *(F.countDistinct(c).alias(f"n_{c}") for c in vary_cols))
    return counted.withColumn("varies", F.greatest(*(F.col(f"n_{c}") for c in vary_cols), F.lit(0)) > 1)


def multiply(forms: DataFrame, judged: DataFrame, on: Sequence[str], order: Sequence[str], vary_cols: Sequence[str], list_col: str, list_name: str, first_cols: dict[str, str]) -> DataFrame:
    """Forms whose judgments differ in ``vary_cols`` get a row for each judgment, all others one row; each row has the full list.

    Opt-in: by default a form stays one row.
    """
    gathered = aggregate(judged, on, order, {list_col: list_name}, first_cols)
    many = multiplicity(judged, on, vary_cols).where("varies").select(*on)
    each = judged.join(many, list(on), "left_semi").select(*on, *(F.col(c).alias(out) for c, out in first_cols.items())).join(gathered.select(*on, list_name), list(on))
    rows = gathered.join(many, list(on), "left_anti").unionByName(each)
    return forms.join(rows, list(on), "left")
