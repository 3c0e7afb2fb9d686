"""From dataset directories to the published tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossaria.functions import descriptor
from glossaria.functions.text import prefix_value
from glossaria.operators import bibliography, enrich, judgments, membership, normalize, quality
from glossaria.schemas import FORMS_WORKING, FORMS_WRITTEN, JUDGMENT_COLUMNS, JUDGMENT_NAMES, LANGUAGES, PARAMETERS
from glossaria.sources import files, sinks
from glossaria.sources.files import EXTRA, HEADER, POSITION, TOO_MANY, Survey
from glossaria.sources.staging import delete, stage, staged

SORT = ("Parameter_ID", "Language_ID", "Local_ID", "ID")
#: Marks the rows that keep their dataset out, in tables that are written before these are known.
FAULT = "_fault"
#: What rows of forms carry for the tallies.
MASKS = (normalize.FILLED, normalize.HAS)


@dataclass
class Corpus:
    """The tables of one collection; all are lazy."""

    forms: DataFrame
    languages: DataFrame
    parameters: DataFrame
    metadata: DataFrame
    references: DataFrame
    bibliography: DataFrame
    headers: DataFrame
    tallies: DataFrame

    def stats(self) -> DataFrame:
        return quality.dataset_stats(self.forms, self.languages, self.parameters, self.metadata)

    def written_forms(self) -> DataFrame:
        return self.forms.select(*FORMS_WRITTEN)

    def report(self) -> DataFrame:
        stats = self.stats()
        systems = {f"{s}_Version": s.lower() for s in ("Glottolog", "Concepticon", "CLTS")}
        versions = quality.version_distribution(self.references, systems)
        complete = quality.cell_completeness(quality.completeness(stats, self.headers), self.tallies)
        whole = enrich.integrity(self.forms, self.languages, self.parameters).join(bibliography.unresolved_count(self.forms, self.bibliography))  # one row each
        return quality.report(quality.rollup(stats), complete, versions, whole, self.tallies)


def in_order(df: DataFrame, columns: Sequence[str] = SORT, dataset: str = "Dataset") -> DataFrame:
    """Rows by dataset and then ``columns``, nulls last, over all partitions."""
    return df.orderBy(F.col(dataset).asc_nulls_last(), *(F.col(c).asc_nulls_last() for c in columns))


def numbered(df: DataFrame, columns: Sequence[str] = SORT, name: str = "place", dataset: str = "Dataset") -> DataFrame:
    """``df`` with each row's place (from 1) in the order of :func:`in_order`, however large a dataset is.

    The sorted rows are written once, so that their partitions stay what they are; sizes of partitions then give places.
    """
    held = stage(in_order(df, columns, dataset).withColumn("__at", F.monotonically_increasing_id()), "in-order").withColumn("__block", F.shiftright("__at", 33))
    sizes = held.groupBy("__block").agg(F.count(F.lit(1)).alias("__n"))  # a row for each partition
    before = F.sum("__n").over(Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))
    placed = held.join(sizes.select("__block", F.coalesce(before, F.lit(0)).alias("__before")), "__block")
    return placed.withColumn(name, F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).select(*df.columns, name)


def enriched_forms(forms: DataFrame, judged: DataFrame | None, languages: DataFrame, parameters: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Forms with their judgments and their parents' columns: the 24 working columns, how many judgments each has, and what else of the forms is named.

    One shuffle, on dataset and form, gathers and attaches the judgments; parents are joined as their size allows.
    What a file's own column says wins over joined values in the whole file, nulls included.
    """
    has = {c: F.array_contains(HEADER, c) for c in FORMS_WORKING}
    own = prefix_value(F.col("Dataset"), F.col("Cognacy"))
    out = forms.withColumn("Cognacy", own)
    if judged is not None:
        names = {c: JUDGMENT_NAMES.get(c, c) for c in JUDGMENT_COLUMNS}
        gathered = judgments.aggregate(judged.withColumnRenamed("Form_ID", "ID"), ["Dataset", "ID"], [POSITION], {"Cognateset_ID": "__sets"}, names, more={quality.JUDGED: F.count(F.lit(1)), quality.ALIGNED: F.size(F.collect_set("Alignment")).cast("long")})
        out = judgments.attach(out, gathered, ["Dataset", "ID"], {c: has[c] for c in names.values()})
        out = out.withColumn("Cognacy", judgments.cognacy(F.col("Cognacy"), F.col("__sets"))).drop("__sets")
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("long")) if c in out.columns else F.lit(0).cast("long") for c in (quality.JUDGED, quality.ALIGNED)})
    out = enrich.attach_parent(out, languages, "Language_ID", "ID", ["Glottocode", "Glottolog_Name"], "Dataset", has)
    out = enrich.attach_parent(out, parameters, "Parameter_ID", "ID", ["Concepticon_ID", "Concepticon_Gloss"], "Dataset", has)
    return out.select(*FORMS_WORKING, quality.JUDGED, quality.ALIGNED, *carry)


def process(spark: SparkSession, root: str, datasets: list[str] | None = None) -> Corpus:
    """The full collection as one lazy plan over all datasets that nothing keeps out (or those named).

    Which ones these are is found out first, by a listing, the header lines and one reading for faults; the plan then
    has one scan for each table and header line.
    """
    good = files.accepted(spark, root, datasets)
    raw = {n: files.read_table(spark, root, n, found=good) for n in ("forms.csv", "languages.csv", "parameters.csv", "cognates.csv")}
    languages, parameters = normalize.languages(raw["languages.csv"]), normalize.parameters(raw["parameters.csv"])
    judged = normalize.judgments(raw["cognates.csv"]) if good.of("cognates.csv") else None
    forms = enriched_forms(normalize.forms(normalize.cell_masks(raw["forms.csv"]), MASKS), judged, languages, parameters, MASKS)
    return Corpus(forms.select(*FORMS_WORKING), languages.select(*LANGUAGES), parameters.select(*PARAMETERS), **_told(spark, root, good), tallies=quality.tallies(forms))


def _told(spark: SparkSession, root: str, good: Survey) -> dict[str, DataFrame]:
    """The tables that descriptors, headers and bibliographies make."""
    described = descriptor.described(files.read_descriptors(spark, root, good))
    told = [(d, "cognates.csv" in held, good.headers[d, "forms.csv"]) for d, held in sorted(good.paths.items())]
    known = spark.createDataFrame(told, "Dataset string, Has_Cognates boolean, columns array<string>")  # a row for each dataset
    meta = descriptor.metadata(described.join(known.select("Dataset", "Has_Cognates"), "Dataset"), F.col("Has_Cognates"))
    books = bibliography.rekeyed_entries(files.read_text(spark, root, "sources.bib", good))
    return {"metadata": meta, "references": descriptor.references(described), "bibliography": books, "headers": known.select("Dataset", "columns")}


def write_full(spark: SparkSession, root: str, place: Callable[[str], str], datasets: Sequence[str] | None = None) -> tuple[Corpus, list[tuple[str, str, str]]]:
    """Writes the tables of the full collection (or of the datasets named) to ``place(table)``, each a folder per dataset, and reads each file of a table once.

    Returns the tables as written and what keeps datasets out: dataset, file, reason. Rows with too many cells are found
    by the same scan that everything else is made of, so rows of their datasets may lie in the folders; the returned
    tables leave them out, and so must whoever names the datasets of a folder.
    """
    found = files.survey(spark, root, datasets)
    bad = files.faults(spark, root, found)
    before = staged(spark)
    flag = lambda name: files.read_table(spark, root, name, found=found.without({b[0] for b in bad})).withColumns({FAULT: F.col(EXTRA).isNotNull(), sinks.DEAL: F.xxhash64(POSITION)})
    faulty = lambda df, name: bad.extend((r["Dataset"], name, TOO_MANY) for r in df.where(FAULT).select("Dataset").distinct().orderBy("Dataset").collect())  # noqa: E731  names of directories

    def kept(df: DataFrame, table: str, *sources: str) -> DataFrame:
        sinks.write_table(df, place(table), "Dataset", "overwrite", found.sizes(*sources))
        held = df.drop(sinks.DEAL)
        back = spark.read.schema(held.schema).parquet(place(table)).select(*held.columns)
        faulty(back, sources[0])
        return back

    languages = kept(normalize.languages(flag("languages.csv"), [FAULT, sinks.DEAL]), "languages", "languages.csv")
    parameters = kept(normalize.parameters(flag("parameters.csv"), [FAULT, sinks.DEAL]), "parameters", "parameters.csv")
    judged = None
    if found.without({b[0] for b in bad}).of("cognates.csv"):
        judged = stage(normalize.judgments(flag("cognates.csv"), [FAULT]), "judgments")
        faulty(judged, "cognates.csv")
    carry = [FAULT, *MASKS, sinks.DEAL]
    forms = kept(enriched_forms(normalize.forms(normalize.cell_masks(flag("forms.csv")), carry), judged, languages, parameters, carry), "forms", "forms.csv", "cognates.csv")
    delete(spark, [p for p in staged(spark) if p not in before])
    told = _told(spark, root, found.without({b[0] for b in bad})) | {"tallies": quality.tallies(forms.where(~F.col("Dataset").isin(sorted({b[0] for b in bad}))))}
    for table, df in told.items():
        sinks.write_table(df, place(table))
        told[table] = spark.read.schema(df.schema).parquet(place(table)).select(*df.columns)
    out = ~F.col("Dataset").isin(sorted({b[0] for b in bad}))
    rows = {"forms": forms.select(*FORMS_WORKING), "languages": languages.select(*LANGUAGES), "parameters": parameters.select(*PARAMETERS)}
    return Corpus(**{table: df.where(out) for table, df in rows.items()}, **told), sorted(bad)


def select_members(corpus: Corpus, registry: DataFrame, flag: str | None) -> Corpus:
    return Corpus(*(membership.members(getattr(corpus, f), registry, flag) for f in Corpus.__dataclass_fields__))


def build_corpus(spark: SparkSession, root: str, registry_path: str, target: str | None = None, datasets: list[str] | None = None) -> dict[str, Corpus]:
    """All collections. With ``target``, the full one is written once by :func:`write_full` and the others are read from it.

    Without a target nothing is written (a dry run) and every table stays lazy.
    """
    full = process(spark, root, datasets) if target is None else write_full(spark, root, lambda table: f"{target}/full/{table}", datasets)[0]
    registry = files.read_registry(spark, registry_path)
    out = {name: select_members(full, registry, flag) for name, flag in membership.COLLECTIONS.items()}
    if target is not None:
        for name, corpus in out.items():
            sinks.write_report(corpus.report(), f"{target}/{name}/report")
            if name != "full":
                for table in Corpus.__dataclass_fields__:
                    sinks.write_table(getattr(corpus, table), f"{target}/{name}/{table}")
    return out


def export(corpus: Corpus, folder: str) -> None:
    """The published CSV files, bibliography and report of one collection."""
    sinks.export_csv(in_order(corpus.forms), f"{folder}/forms.csv", FORMS_WRITTEN)
    for name in ("languages", "parameters", "metadata"):
        sinks.export_csv(getattr(corpus, name).orderBy("Dataset"), f"{folder}/{name}.csv")
    sinks.write_bibliography(corpus.bibliography, f"{folder}/sources.bib")
    sinks.write_report(corpus.report(), f"{folder}/validation_report.json")
