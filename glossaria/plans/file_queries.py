"""Demo queries over files: the given tables are written as datasets with differing headers, and the collections are built of them.

Each region is a dataset: its orders are forms, its customers languages, order priorities parameters and line items
judgments. Datasets differ in their columns, one has no judgments, and two more are faulty and must be left out. Every
table is a folder of part files, written by Spark, each with a run of the rows: of the judgments of a form, some stand in
one part and some in the next.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaria.operators import bibliography, release
from glossaria.plans import corpus
from glossaria.schemas import FORMS_WRITTEN, RELEASE_FILES
from glossaria.sources import files
from glossaria.sources.staging import fresh_path, stage, staged

C = F.col
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate")
#: Columns of each dataset's forms, in the order of its header.
FORMS = {
    "africa": ("ID", "Language_ID", "Parameter_ID", "Value", "Loan", "Source", "Cognacy"),
    "america": ("Alignment", "Source", "Loan", "Value", "Parameter_ID", "Language_ID", "ID"),
    "asia": ("ID", "Language_ID", "Parameter_ID", "Source"),
    "europe": ("Extra", "ID", "Parameter_ID", "Language_ID", "Value", "Loan", "Source"),
    "middleeast": ("ID", "Language_ID", "Parameter_ID", "Value", "Loan", "Source"),
}
WITHOUT_JUDGMENTS = "middleeast"
#: Datasets that are written at once.
WRITERS = 4
#: A dataset whose forms lack a key column, and one whose descriptor is broken.
FAULTY = {"lacking": "africa", "broken": "asia"}


def _csv(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    df.write.partitionBy(*by).csv(path, header=True, escape='"', emptyValue="")


def _csv_each(df: DataFrame, root: str, name: str, datasets: Sequence[str]) -> None:
    """Writes a table that has the same columns in all datasets by one job, each dataset's rows in the order of their partition, and puts each folder in its place."""
    spark, made = df.sparkSession, f"{root}-{name}"
    _csv(df, made, ("ds",))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(made).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for ds in datasets:
        fs.mkdirs(path(f"{root}/{ds}/cldf"))
        own, to = path(f"{made}/ds={ds}"), path(f"{root}/{ds}/cldf/{name}")
        if not fs.exists(own):
            _csv(df.where(C("ds") == ds).drop("ds"), f"{root}/{ds}/cldf/{name}")  # no rows: a header
        elif not fs.rename(own, to):
            raise OSError(f"{own} can't be moved to {to}")
    fs.delete(path(made), True)


#: Folders of datasets by application and input, as long as they have not been deleted.
_written: dict[tuple[str, str], str] = {}


def write_datasets(spark: SparkSession, sf_dir: str) -> str:
    """Writes the datasets, and a registry of them beside, into a new folder, once for each session and input; returns its path."""
    key = spark.sparkContext.applicationId, sf_dir
    if _written.get(key) not in staged(spark):
        _written[key] = _write_datasets(spark, sf_dir)
    return _written[key]


def _write_datasets(spark: SparkSession, sf_dir: str) -> str:
    t = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    root = fresh_path(spark, "datasets")
    placed = t("customer").join(t("nation"), C("n_nationkey") == C("c_nationkey")).join(t("region"), C("r_regionkey") == C("n_regionkey")).withColumn("ds", F.replace(F.lower("r_name"), F.lit(" "), F.lit("")))
    orders = t("orders").join(placed.select("c_custkey", "ds"), C("o_custkey") == C("c_custkey"))
    forms = orders.select(
        "ds", C("o_orderkey").alias("ID"), C("o_custkey").alias("Language_ID"), C("o_orderpriority").alias("Parameter_ID"), C("o_orderstatus").alias("Value"), C("o_orderpriority").alias("Cognacy"),
        F.when(C("o_orderstatus") == "F", "true").when(C("o_orderstatus") == "O", "false").otherwise("True").alias("Loan"), F.nullif("o_orderstatus", F.lit("F")).alias("Alignment"), F.lit("x, \"y\"").alias("Extra"),
        F.concat(F.lit("K"), (C("o_custkey") % 7).cast("string"), F.lit("; K"), (C("o_orderkey") % 5).cast("string"), F.lit(";")).alias("Source"),
    )
    languages = placed.select("ds", C("c_custkey").alias("ID"), C("c_name").alias("Name"), C("c_mktsegment").alias("Glottocode"), C("n_name").alias("Glottolog_Name"), C("c_acctbal").alias("Latitude"), F.when(C("c_custkey") % 2 == 0, "abc").otherwise("12").alias("Longitude"))
    parameters = t("orders").select(C("o_orderpriority").alias("ID")).distinct().select("ID", C("ID").alias("Name"), F.substring("ID", 1, 1).alias("Concepticon_ID"), F.when(C("ID") != "5-LOW", F.substring("ID", 3, 99)).alias("Concepticon_Gloss"))
    judged = t("lineitem").join(orders.select("o_orderkey", "ds").where(C("ds") != WITHOUT_JUDGMENTS), C("l_orderkey") == C("o_orderkey")).select(
        *LINE_ORDER,
        "ds", C("l_orderkey").alias("Form_ID"), F.concat("l_returnflag", C("l_linenumber").cast("string")).alias("Cognateset_ID"), F.when(C("l_linestatus") != "F", F.concat("l_linestatus", (C("l_linenumber") % 2).cast("string"))).alias("Alignment"),
        F.when(C("l_returnflag") == "R", "true").when(C("l_returnflag") == "A", "false").otherwise("").alias("Doubt"), F.lit("K1").alias("Source"),
    )
    forms, languages = (stage(df, "demo", "ds") for df in (forms, languages))  # joined once for all datasets, each of which reads its own rows
    parameters = stage(parameters, "demo")
    twice = F.explode(F.coalesce(*(F.when(C("ds") == of, F.array(F.lit(of), F.lit(ds))) for ds, of in FAULTY.items()), F.array("ds")))
    region = t("region").select(F.replace(F.lower("r_name"), F.lit(" "), F.lit("")).alias("ds"), "r_regionkey")

    def write(ds: str) -> None:
        own = C("ds") == FAULTY.get(ds, ds)
        to = f"{root}/{ds}/cldf"
        columns = FORMS.get(ds) or ("ID", "Language_ID") + ("Parameter_ID",) * (ds != "lacking")
        _csv(forms.where(own).select(*columns), f"{to}/forms.csv")
        _csv(parameters, f"{to}/parameters.csv")
        table = lambda kind, n: F.struct(F.lit(f"http://x.org/terms#{kind}Table").alias("dc:conformsTo"), n.cast("long").alias("dc:extent"))
        made = lambda title, v: F.struct(F.lit(title).alias("dc:title"), F.concat(F.lit("v"), v.cast("string")).alias("dc:created"))
        described = F.to_json(
            F.struct(
                C("ds").alias("dc:title"), F.lit("http://x.org/terms#Wordlist").alias("dc:conformsTo"), F.array(table("Form", 100 * C("r_regionkey")), table("Language", C("r_regionkey"))).alias("tables"),
                F.array(made("Repository", C("r_regionkey")), made("Glottolog", C("r_regionkey") % 2)).alias("prov:wasDerivedFrom"),
            )
        )
        region.where(own).select(described if ds != "broken" else F.substring(described, 1, 40)).coalesce(1).write.text(f"{to}/cldf-metadata.json")
        entries = languages.where(own).select((C("ID") % 7).alias("k")).distinct().select(F.concat(F.lit("@misc{K"), C("k").cast("string"), F.lit(",\n note={a@b.c}}\n")).alias("value"))
        entries.coalesce(1).write.text(f"{to}/sources.bib")

    names = [*FORMS, *FAULTY]
    with ThreadPool(WRITERS) as pool:  # small jobs, run side by side
        pool.map(write, names)
    _csv_each(languages.withColumn("ds", twice), root, "languages.csv", names)
    held = judged.withColumn("ds", twice).repartitionByRange(*LINE_ORDER)  # a form's judgments lie in many parts
    _csv_each(held.sortWithinPartitions("ds", *LINE_ORDER).drop(*LINE_ORDER), root, "cognates.csv", [ds for ds in names if ds != WITHOUT_JUDGMENTS])
    listed = region.select(C("ds").alias("NAME"), F.lit("https://x.org").alias("URL"), F.when(C("r_regionkey") % 2 == 0, "TRUE").alias("CoreCog"), F.when(C("r_regionkey") < 2, "TRUE").alias("CORE"))
    _csv(listed, f"{root}-registry.csv")
    return root


_LINES = ", ".join(LINE_ORDER)
_PLACED = """
placed AS (
  SELECT c.*, n_name, r_regionkey, replace(lower(r_name), ' ', '') AS ds FROM customer c JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)"""
_FORMS = f"""{_PLACED},
gathered AS (
  SELECT l_orderkey, string_agg(concat(ds, '_', l_returnflag, l_linenumber), ';' ORDER BY {_LINES}) AS sets, arg_min(concat(l_linestatus, l_linenumber % 2), ({_LINES})) FILTER (l_linestatus <> 'F') AS alignment,
    arg_min(l_returnflag = 'R', ({_LINES})) FILTER (l_returnflag IN ('R', 'A')) AS doubt
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN placed ON c_custkey = o_custkey WHERE ds <> '{WITHOUT_JUDGMENTS}' GROUP BY l_orderkey),
forms AS (
  SELECT concat(ds, '_', o_orderkey) AS ID, ds AS "Dataset", concat(ds, '_', o_custkey) AS Language_ID, concat(ds, '_', o_orderpriority) AS Parameter_ID, CASE WHEN ds <> 'asia' THEN o_orderstatus END AS Value,
    CASE WHEN ds = 'asia' THEN NULL WHEN o_orderstatus = 'F' THEN true WHEN o_orderstatus = 'O' THEN false END AS Loan, concat(ds, '_K', o_custkey % 7, ';', ds, '_K', o_orderkey % 5) AS Source,
    nullif(concat_ws(';', CASE WHEN ds = 'africa' THEN concat(ds, '_', o_orderpriority) END, sets), '') AS Cognacy, CASE WHEN ds = 'america' THEN nullif(o_orderstatus, 'F') ELSE alignment END AS Alignment, doubt AS Doubt,
    CASE WHEN sets IS NOT NULL THEN concat(ds, '_K1') END AS Cognate_Source, c_mktsegment AS Glottocode, n_name AS Glottolog_Name, substring(o_orderpriority, 1, 1) AS Concepticon_ID,
    CASE WHEN o_orderpriority <> '5-LOW' THEN substring(o_orderpriority, 3) END AS Concepticon_Gloss
  FROM orders JOIN placed ON c_custkey = o_custkey LEFT JOIN gathered ON l_orderkey = o_orderkey)"""

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


@query(f"WITH {_FORMS} SELECT * FROM forms")
def built_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms of the full collection, straight from the files."""
    full = corpus.process(spark, write_datasets(spark, sf_dir))
    return full.forms.select("ID", "Dataset", "Language_ID", "Parameter_ID", "Value", "Loan", "Source", "Cognacy", "Alignment", "Doubt", "Cognate_Source", "Glottocode", "Glottolog_Name", "Concepticon_ID", "Concepticon_Gloss")


@query(f"""
WITH {_PLACED},
members AS (SELECT DISTINCT ds, r_regionkey FROM placed)
SELECT m.ds AS "Dataset", m.ds AS "Title", 'Wordlist' AS "CLDF_Module", concat('v', r_regionkey) AS "Repository_Version", CAST(100 * r_regionkey AS BIGINT) AS "Form_Count", CAST(r_regionkey AS BIGINT) AS "Language_Count",
  CAST(0 AS BIGINT) AS "Parameter_Count", m.ds <> '{WITHOUT_JUDGMENTS}' AS "Has_Cognates", concat('v', r_regionkey % 2) AS "Glottolog_Version",
  CASE m.ds WHEN 'africa' THEN '{",".join(FORMS["africa"])}' WHEN 'america' THEN '{",".join(FORMS["america"])}' WHEN 'asia' THEN '{",".join(FORMS["asia"])}' WHEN 'europe' THEN '{",".join(FORMS["europe"])}' ELSE '{",".join(FORMS["middleeast"])}' END AS header,
  (SELECT count(DISTINCT c_custkey % 7) FROM placed p WHERE p.ds = m.ds) AS n_entries, 'broken;lacking' AS skipped
FROM members m
""")
def built_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What descriptors, headers and bibliographies of the files tell of each dataset, and which datasets were left out."""
    target = fresh_path(spark, "full")
    full, bad = corpus.write_full(spark, write_datasets(spark, sf_dir), lambda table: f"{target}/{table}")
    cited = full.bibliography.groupBy("Dataset").agg(F.count("key").alias("n_entries"))
    out = full.metadata.join(full.references.select("Dataset", "Glottolog_Version"), "Dataset").join(full.headers.select("Dataset", F.array_join("columns", ",").alias("header")), "Dataset").join(cited, "Dataset")
    skipped = files.skipped(spark.createDataFrame(bad, "Dataset string, file_name string, reason string")).select("skipped")  # one row
    return out.join(skipped).select("Dataset", "Title", "CLDF_Module", "Repository_Version", "Form_Count", "Language_Count", "Parameter_Count", "Has_Cognates", "Glottolog_Version", "header", "n_entries", "skipped")


@query(f"""
WITH {_FORMS},
judged AS (
  SELECT ds, l_orderkey, count(*) AS n, count(DISTINCT l_linenumber % 2) FILTER (l_linestatus <> 'F') AS kinds
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN placed ON c_custkey = o_custkey WHERE ds <> '{WITHOUT_JUDGMENTS}' GROUP BY ALL),
multiple AS (SELECT ds, count(*) FILTER (n > 1) AS sets, count(*) FILTER (kinds > 1) AS alignments, coalesce(sum(n - 1) FILTER (kinds > 1), 0) AS more FROM judged GROUP BY ds),
cells AS (
  SELECT ds, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f FROM orders JOIN placed ON c_custkey = o_custkey GROUP BY ds)
SELECT c.ds AS "Dataset", CAST(coalesce(sets, 0) AS BIGINT) AS multiple_cognatesets, CAST(coalesce(alignments, 0) AS BIGINT) AS multiple_alignments, CAST(coalesce(more, 0) AS BIGINT) AS duplicate_ids,
  CAST(CASE WHEN c.ds = 'america' THEN n - f ELSE 0 END AS BIGINT) AS alignments_filled, CAST(CASE WHEN c.ds = 'america' THEN f ELSE 0 END AS BIGINT) AS alignments_empty,
  CAST(CASE WHEN c.ds = 'america' THEN 0 ELSE n END AS BIGINT) AS alignments_missing, CAST(CASE WHEN c.ds = 'asia' THEN 0 ELSE n END AS BIGINT) AS values_filled, c.ds <> 'africa' AS lacks_cognacy,
  CAST((SELECT coalesce(sum(sets), 0) FROM multiple) AS BIGINT) AS all_multiple_cognatesets, CAST((SELECT coalesce(sum(more), 0) FROM multiple) AS BIGINT) AS all_duplicate_ids,
  CAST((SELECT count(DISTINCT concat(ds, k)) FROM (SELECT ds, unnest([o_custkey % 7, o_orderkey % 5]) AS k FROM orders JOIN placed ON c_custkey = o_custkey) u
    WHERE (ds, k) NOT IN (SELECT ds, c_custkey % 7 FROM placed)) AS BIGINT) AS invalid_bibtex_references
FROM cells c LEFT JOIN multiple USING (ds)
""")
def built_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of the whole report, a row for each dataset: what judgments multiply, which cells are filled, empty or missing, columns that are absent, citations that don't resolve."""
    target = fresh_path(spark, "full")
    full, _ = corpus.write_full(spark, write_datasets(spark, sf_dir), lambda table: f"{target}/{table}")
    report = full.report()
    rows = report.select("summary", "row_multiplication", "referential_integrity", F.explode("completeness").alias("Dataset", "of"))
    counted = full.tallies.select("Dataset", "multiple_cognatesets", "multiple_alignments", "duplicate_ids")
    cells = lambda c, kind: C("of.empty_vs_missing")[c][kind]
    return rows.join(counted, "Dataset").select(
        "Dataset", "multiple_cognatesets", "multiple_alignments", "duplicate_ids", cells("Alignment", "filled").alias("alignments_filled"), cells("Alignment", "empty_string").alias("alignments_empty"),
        cells("Alignment", "missing_na").alias("alignments_missing"), cells("Value", "filled").alias("values_filled"), F.array_contains("of.columns_absent", "Cognacy").alias("lacks_cognacy"),
        C("summary.forms_with_multiple_cognatesets").alias("all_multiple_cognatesets"), C("row_multiplication.total_duplicate_ids_from_cognates").alias("all_duplicate_ids"), C("referential_integrity.invalid_bibtex_references").alias("invalid_bibtex_references"),
    )


@query(f"""
WITH {_FORMS},
collections(collection, least, step) AS (VALUES ('full', 9, 1), ('core', 2, 1), ('corecog', 9, 2)),
regions AS (SELECT collection, replace(lower(r_name), ' ', '') AS ds, r_regionkey FROM collections JOIN region ON r_regionkey < least AND r_regionkey % step = 0)
SELECT r.collection, count(DISTINCT r.ds) AS datasets_count, count(*) AS forms_count, (SELECT count(*) FROM placed p JOIN regions x USING (ds) WHERE x.collection = r.collection) AS languages_count,
  count(DISTINCT r.ds) FILTER (r.ds <> '{WITHOUT_JUDGMENTS}') AS cognates_datasets, round_even(100 * count(Cognacy) / count(*), 2) AS cognate_coverage, round_even(100 * count(Alignment) / count(*), 2) AS alignment_coverage,
  CASE WHEN min(r_regionkey % 2) = max(r_regionkey % 2) THEN concat('v', min(r_regionkey % 2)) ELSE 'v0-v1' END AS glottolog_versions, 'unknown' AS clts_versions, CAST(0 AS BIGINT) AS orphan_languages,
  CAST(2 * (SELECT count(DISTINCT concat(ds, c_custkey % 7)) FROM placed p JOIN regions x USING (ds) WHERE x.collection = r.collection) AS BIGINT) AS sources_entries,
  CASE r.collection WHEN 'core' THEN 'forms_csv;languages_csv;metadata_csv;parameters_csv;sources_bib;validation_report_json' END AS released,
  CASE r.collection WHEN 'core' THEN 'corpus.A.core.20240101.zip' END AS archive_name, CAST(CASE r.collection WHEN 'core' THEN 1 ELSE 0 END AS BIGINT) AS missing,
  CAST(CASE r.collection WHEN 'core' THEN sum(CAST('0x' || md5(concat_ws('|', ID, Value, CASE WHEN Loan THEN 'y' WHEN NOT Loan THEN 'n' END, Source, Cognacy, Alignment, Glottocode))[1:8] AS BIGINT)) END AS BIGINT) AS exported
FROM forms f JOIN regions r ON r.ds = f.Dataset GROUP BY r.collection
""")
def built_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of each collection, from the reports and bibliographies that a build wrote, and what the ledger has of the core collection, which is exported.

    It is in the ledger from an earlier release and is replaced; one file that is asked of it is missing.
    """
    root = write_datasets(spark, sf_dir)
    target = fresh_path(spark, "collections")
    built = corpus.build_corpus(spark, root, f"{root}-registry.csv", target)
    told = []
    for name, tables in built.items():
        report = files.read_report(spark, f"{target}/{name}/report")
        told.append(release.report_statistics(report, bibliography.entry_counts(tables.bibliography, "text")).withColumn("collection", F.lit(name)))
    corpus.export(built["core"], f"{target}/export")
    found = files.release_files(spark, f"{target}/export").withColumn("collection", F.lit("core"))
    needed = spark.createDataFrame([("core", n) for n in (*RELEASE_FILES, "extra.csv")], "collection string, file_name string")
    missing = release.gate(needed, found, ["collection", "file_name"]).groupBy("collection").agg(F.count(F.lit(1)).alias("missing"))
    rows = release.manifest(found, "A.20240101", expected=RELEASE_FILES)
    before = rows.where("collection = 'core'").withColumn("sha256", F.lit("of an earlier release"))
    ledger = release.ledger_upsert(before, rows, force=True).where((F.length("sha256") == 64) & (F.col("size") > 0))
    held = ledger.groupBy("collection").agg(F.array_join(F.array_sort(F.collect_list("file_key")), ";").alias("released"), F.max("archive_name").alias("archive_name"))
    published = files.read_published(spark, f"{target}/export/forms.csv", FORMS_WRITTEN)
    spelled = F.concat_ws("|", "ID", "Value", F.when(C("Loan"), "y").when(~C("Loan"), "n"), "Source", "Cognacy", "Alignment", "Glottocode")
    content = published.agg(F.sum(F.conv(F.substring(F.md5(spelled), 1, 8), 16, 10).cast("long")).alias("exported")).withColumn("collection", F.lit("core"))
    out = reduce(DataFrame.union, told).join(held, "collection", "left").join(content, "collection", "left").join(missing, "collection", "left").withColumn("missing", F.coalesce("missing", F.lit(0)))
    return out.select(
        "collection", "datasets_count", "forms_count", "languages_count", "cognates_datasets", "cognate_coverage", "alignment_coverage", "glottolog_versions", "clts_versions", "orphan_languages", "sources_entries",
        "released", "archive_name", "missing", "exported",
    )
