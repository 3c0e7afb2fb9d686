"""Quality figures: one row of mergeable counts for each dataset, rolled up to collections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossaria.functions.figures import percentage
from glossaria.operators.normalize import CELLS, FILLED, HAS

#: Columns whose coverage is reported, those of whose nulls the share is, and those of partial judgments.
COVERAGE = {"Glottocode": "glottocode_coverage_percent", "Concepticon_ID": "concepticon_coverage_percent", "Cognacy": "forms_with_cognate_data_percent", "Segments": "forms_with_segments_percent", "Alignment": "forms_with_alignment_percent"}
NULLS = ("Segments", "Comment", "Loan", "Cognacy", "Alignment")
PARTIAL = {"Morpheme_Index": "morpheme_index", "Segment_Slice": "segment_slice"}


def filled_counts(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``n_rows`` and the non-null values ``n_<column>`` of each group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *(F.count(c).alias(f"n_{c}") for c in cols))


def null_percentage(df: DataFrame, by: Sequence[str], cols: Sequence[str], digits: int = 1) -> DataFrame:
    counts = filled_counts(df, by, cols)
    return counts.select(*by, *(percentage(F.col("n_rows") - F.col(f"n_{c}"), F.col("n_rows"), digits).alias(f"{c}_null_pct") for c in cols))


def coverage(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), digits: int = 2) -> DataFrame:
    counts = filled_counts(df, by, cols)
    return counts.select(*by, "n_rows", *(percentage(F.col(f"n_{c}"), F.col("n_rows"), digits).alias(f"{c}_pct") for c in cols))


def missing_split(df: DataFrame, by: Sequence[str], cols: Sequence[str], header: str | None = None) -> DataFrame:
    """Per group and column of raw text: rows that are ``filled``, ``empty``, or of a file without the column (``absent``)."""
    tall = df.select(*by, *([F.col(header).alias("__header")] if header else []), F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("cell")) for c in cols))).alias("p"))
    there = F.array_contains("__header", F.col("p.column")) if header else F.lit(True)
    blank = F.coalesce(F.col("p.cell"), F.lit("")) == ""
    return tall.groupBy(*by, F.col("p.column").alias("column")).agg(F.count_if(there & ~blank).alias("filled"), F.count_if(there & blank).alias("empty"), F.count_if(~there).alias("absent"))


def dataset_stats(forms: DataFrame, languages: DataFrame, parameters: DataFrame, metadata: DataFrame) -> DataFrame:
    """A row per dataset of ``metadata``: counts of rows and of filled columns. Sums of them hold for any set of datasets."""
    tracked = list(dict.fromkeys([*COVERAGE, *NULLS, *PARTIAL]))
    counted = filled_counts(forms, ["Dataset"], tracked).withColumnRenamed("n_rows", "forms")
    n = lambda t, name: t.groupBy("Dataset").agg(F.count(F.lit(1)).alias(name))
    out = metadata.select("Dataset", F.col("Has_Cognates").alias("has_cognates"))
    for part in (counted, n(languages, "languages"), n(parameters, "parameters")):
        out = out.join(part, "Dataset", "left")
    return out.fillna(0)


#: Judgments of a form, and different alignments among them, as :func:`tallies` takes them.
JUDGED, ALIGNED = "_judged", "_aligned"
TALLIES = "Dataset string, cells map<string,struct<filled:bigint,empty_string:bigint,missing_na:bigint>>, multiple_cognatesets bigint, multiple_alignments bigint, duplicate_ids bigint"


def tallies(forms: DataFrame) -> DataFrame:
    """Per dataset, by one aggregation: how many cells of each column are filled, empty, or of a file without the column, and what judgments multiply.

    ``forms`` has the masks of :func:`normalize.cell_masks` and ``_judged`` and ``_aligned`` for each row.
    ``multiple_cognatesets`` counts forms with several judgments, ``multiple_alignments`` those whose judgments differ in
    their alignment, and ``duplicate_ids`` the rows that a row per judgment would add for these.
    """
    bit = lambda mask, k: F.sum(F.shiftright(mask, k).bitwiseAND(F.lit(1).cast("long")))
    many = F.col(ALIGNED) > 1
    counted = forms.groupBy("Dataset").agg(
        F.count(F.lit(1)).alias("__n"), *(f for k, _ in enumerate(CELLS) for f in (bit(FILLED, k).alias(f"__f{k}"), bit(HAS, k).alias(f"__h{k}"))),
        F.count_if(F.col(JUDGED) > 1).alias("multiple_cognatesets"), F.count_if(many).alias("multiple_alignments"), F.coalesce(F.sum(F.when(many, F.col(JUDGED) - 1)), F.lit(0)).cast("long").alias("duplicate_ids"),
    )
    cell = lambda k: F.struct(F.col(f"__f{k}").alias("filled"), (F.col(f"__h{k}") - F.col(f"__f{k}")).alias("empty_string"), (F.col("__n") - F.col(f"__h{k}")).alias("missing_na"))
    cells = F.create_map(*(x for k, c in enumerate(CELLS) for x in (F.lit(c), cell(k))))
    return counted.select("Dataset", cells.alias("cells"), "multiple_cognatesets", "multiple_alignments", "duplicate_ids")


def completeness(stats: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """Per dataset: counts, flag, null percentages, and the columns of its forms file if ``headers`` (``Dataset``, ``columns``) are given."""
    out = stats.select("Dataset", "forms", "languages", "parameters", "has_cognates", *(percentage(F.col("forms") - F.col(f"n_{c}"), F.col("forms"), 1).alias(f"{c}_null_pct") for c in NULLS))
    return out if headers is None else out.join(headers.select("Dataset", F.col("columns").alias("columns_present")), "Dataset", "left")


def cell_completeness(complete: DataFrame, counted: DataFrame) -> DataFrame:
    """:func:`completeness` with ``columns_absent``, of those a forms file may have, and ``empty_vs_missing`` for each of them; both empty for a dataset without forms."""
    absent = F.array_except(F.array(*map(F.lit, CELLS)), F.coalesce("columns_present", F.array().cast("array<string>")))
    return complete.withColumn("columns_absent", absent).join(counted.select("Dataset", F.col("cells").alias("empty_vs_missing")), "Dataset", "left")


def declared_completeness(complete: DataFrame, metadata: DataFrame) -> DataFrame:
    """:func:`completeness` with the counts that descriptors declare in place of counted rows, as a report over stored metadata has them."""
    pairs = {"forms": "Form_Count", "languages": "Language_Count", "parameters": "Parameter_Count"}
    told = metadata.select("Dataset", *(F.col(c).alias(f"__{n}") for n, c in pairs.items()))
    return complete.join(told, "Dataset").withColumns({n: F.col(f"__{n}") for n in pairs}).select(*complete.columns)


def rollup(stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The report of all datasets, or of each group of them: summary, coverage and partial judgments.

    ``datasets_with_partial_cognacy`` adds up the two kinds, so a dataset with both counts twice.
    """
    names = lambda c: F.array_sort(F.collect_list(F.when(F.col(f"n_{c}") > 0, F.col("Dataset"))))
    total = stats.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_datasets"), *(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(f"total_{c}") for c in ("forms", "languages", "parameters")),
        F.count_if("has_cognates").alias("datasets_with_cognates"), F.sum(sum((F.col(f"n_{c}") > 0).cast("long") for c in PARTIAL)).alias("datasets_with_partial_cognacy"),
        *(F.sum(f"n_{c}").alias(f"__{c}") for c in COVERAGE),
        *(names(c).alias(f"datasets_with_{name}") for c, name in PARTIAL.items()), *(F.coalesce(F.sum(f"n_{c}"), F.lit(0)).cast("long").alias(f"forms_with_{name}") for c, name in PARTIAL.items()),
    )
    shares = {name: percentage(F.col(f"__{c}"), F.col("total_forms"), 2, None) for c, name in COVERAGE.items()}
    return total.withColumns(shares).drop(*(f"__{c}" for c in COVERAGE))


def version_distribution(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """``system``, ``version``, ``datasets``: how many rows name each version. ``cols``: column to system; null and empty don't count."""
    tall = df.select(F.explode(F.array(*(F.struct(F.lit(s).alias("system"), F.col(c).cast("string").alias("version")) for c, s in cols.items()))).alias("p")).select("p.*")
    return tall.where(F.col("version").isNotNull() & (F.col("version") != "")).groupBy("system", "version").agg(F.count(F.lit(1)).alias("datasets"))


def declared_against_actual(declared: DataFrame, actual: DataFrame, key: Sequence[str], pairs: dict[str, str]) -> DataFrame:
    """Per key: each declared and counted figure and whether they agree. ``pairs``: declared column to counted column."""
    out = declared.join(actual, list(key), "left")
    return out.select(*key, *(c for p in pairs.items() for c in p), *(F.col(a).eqNullSafe(F.coalesce(F.col(b), F.lit(0))).alias(f"{a}_agrees") for a, b in pairs.items()))


def report(rolled: DataFrame, complete: DataFrame, versions: DataFrame, integrity: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """The whole report as one row of nested sections, ready for a JSON sink. All inputs are per dataset or smaller; ``counted`` is that of :func:`tallies`."""
    summary = ["total_datasets", "total_forms", "total_languages", "total_parameters", "datasets_with_cognates", "datasets_with_partial_cognacy"]
    partial = [f"{w}_with_{n}" for w in ("datasets", "forms") for n in PARTIAL.values()]
    per_dataset = complete.agg(F.map_from_entries(F.collect_list(F.struct("Dataset", F.struct(*(c for c in complete.columns if c != "Dataset"))))).alias("completeness"))
    by_system = versions.groupBy("system").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("version", "datasets")))).alias("v"))
    dist = by_system.agg(F.map_from_entries(F.collect_list(F.struct("system", "v"))).alias("version_distribution"))
    if counted is not None:
        total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)
        rolled = rolled.join(counted.agg(total("multiple_cognatesets", "forms_with_multiple_cognatesets"), total("multiple_alignments", "forms_with_multiple_alignments"), total("duplicate_ids", "total_duplicate_ids_from_cognates")))  # one row each
        summary.append("forms_with_multiple_cognatesets")
    more = [] if counted is None else [F.struct("forms_with_multiple_alignments", "total_duplicate_ids_from_cognates").alias("row_multiplication")]
    one = rolled.select(F.struct(*summary).alias("summary"), F.struct(*COVERAGE.values()).alias("data_quality"), F.struct(*partial).alias("partial_cognacy"), *more)
    return one.join(per_dataset).join(integrity.select(F.struct("*").alias("referential_integrity"))).join(dist)  # one row each
