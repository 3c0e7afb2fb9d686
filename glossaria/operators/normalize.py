"""Raw cells into the corpus's keys, flags, numbers and nulls, for all datasets at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossaria.functions import text as fn
from glossaria.schemas import FORMS_WORKING, JUDGMENT_COLUMNS, LANGUAGES, PARAMETERS, kind_of, schema_of
from glossaria.sources.files import HEADER, POSITION


def _each(df: DataFrame, cols: Sequence[str], f) -> DataFrame:
    return df.withColumns({c: f(F.col(f"`{c}`")) for c in cols if c in df.columns})


def prefix_ids(df: DataFrame, cols: Sequence[str], dataset: str = "Dataset") -> DataFrame:
    """Key columns with their dataset in front. Columns that ``df`` lacks are passed over, here and below."""
    return _each(df, cols, lambda c: fn.prefix_id(F.col(dataset), c))


def prefix_key_list(df: DataFrame, cols: Sequence[str], dataset: str = "Dataset", sep: str = ";") -> DataFrame:
    return _each(df, cols, lambda c: fn.prefix_keys(F.col(dataset), c, sep))


def decode_boolean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _each(df, cols, fn.decode_boolean)


def coerce_number(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _each(df, cols, fn.number)


def empty_to_null(df: DataFrame, cols: Sequence[str] | None = None, but: Sequence[str] = ("Dataset",)) -> DataFrame:
    texts = [c for c, kind in df.dtypes if kind == "string" and c not in but] if cols is None else cols
    return _each(df, texts, fn.empty_to_null)


def align(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly ``columns``, in order: missing ones null, all others gone."""
    return df.select(*(F.col(f"`{c}`").cast(kind_of(c)).alias(c) if c in df.columns else F.lit(None).cast(kind_of(c)).alias(c) for c in columns))


def align_to(df: DataFrame, schema) -> DataFrame:
    """:func:`align` to any ``StructType``."""
    return df.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))


def combine(df: DataFrame, cols: Sequence[str], out: str, sep: str = ";") -> DataFrame:
    return df.withColumn(out, fn.combine(*(F.col(f"`{c}`") for c in cols), sep=sep))


def column_flags(df: DataFrame, expected: Sequence[str], header: str = HEADER) -> DataFrame:
    """Whether each expected column stands in the header, as columns ``has_<name>``."""
    return df.withColumns({f"has_{c}": F.array_contains(header, c) for c in expected})


def absent_columns(expected: Sequence[str], header: str = HEADER) -> Column:
    return F.array_except(F.array(*map(F.lit, expected)), F.col(header))


#: Columns of a forms file whose cells are told apart into filled, empty and absent, a bit for each in :func:`cell_masks`.
CELLS = tuple(c for c in FORMS_WORKING if c != "Dataset")
FILLED, HAS = "_filled", "_has"


def cell_masks(raw: DataFrame) -> DataFrame:
    """Rows of ``forms.csv`` with ``_filled`` and ``_has``: bits of the columns whose cell is filled, and of those that the file has, before empty cells become null."""
    bits = lambda held: sum((F.when(h, F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, h in held), F.lit(0).cast("long"))
    filled = bits((k, F.coalesce(F.col(f"`{c}`"), F.lit("")) != "") for k, c in enumerate(CELLS) if c in raw.columns)
    return raw.withColumns({FILLED: filled, HAS: bits((k, _there(c)) for k, c in enumerate(CELLS))})


def _there(c: str) -> Column:
    return F.array_contains(HEADER, c)


def _keys(raw: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys of columns that a file has; those of absent columns are null."""
    d = F.col("Dataset")
    return raw.withColumns({c: F.when(_there(c), fn.prefix_id(d, F.col(c))) for c in cols if c in raw.columns})


def forms(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Rows of ``forms.csv``: the working columns with ``_pos``, ``_header`` and what else is named, here and below."""
    out = _keys(raw, ("ID", "Language_ID", "Parameter_ID"))
    out = decode_boolean(empty_to_null(prefix_key_list(out, ["Source"])), ["Loan"])
    plain = [c for c in FORMS_WORKING if c not in out.columns]
    return out.withColumns({c: F.lit(None).cast(kind_of(c)) for c in plain}).select(*FORMS_WORKING, POSITION, HEADER, *carry)


def languages(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return _with_header(coerce_number(empty_to_null(_keys(raw, ["ID"])), ["Latitude", "Longitude"]), LANGUAGES, carry)


def parameters(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return _with_header(empty_to_null(_keys(raw, ["ID"])), PARAMETERS, carry)


def judgments(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Rows of ``cognates.csv``: the keys, the optional columns, ``_pos`` and ``_header``."""
    out = _keys(raw, ("Form_ID", "Cognateset_ID"))
    out = decode_boolean(empty_to_null(prefix_key_list(out, ["Source"])), ["Doubt"])
    columns = ("Dataset", "Form_ID", "Cognateset_ID", *JUDGMENT_COLUMNS)
    return out.withColumns({c: F.lit(None).cast(kind_of(c)) for c in columns if c not in out.columns}).select(*columns, POSITION, HEADER, *carry)


def _with_header(df: DataFrame, columns: Sequence[str], carry: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast(kind_of(c)) for c in columns if c not in df.columns}).select(*columns, HEADER, *carry)


def empty(spark, columns: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([], schema_of(tuple(columns)))
