"""Demo queries over what is written and read back: registries, single published files, replaced partitions, and headers of datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaria.operators import bibliography, membership, normalize
from glossaria.plans.file_queries import FAULTY, FORMS, write_datasets
from glossaria.schemas import FORMS_WRITTEN
from glossaria.sources import files, sinks
from glossaria.sources.staging import fresh_path

C = F.col
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""
WITH rows AS (
  SELECT CASE WHEN c_custkey % 7 > 0 THEN c_name ELSE '' END AS name, CASE WHEN c_custkey % 5 > 0 THEN concat('https://x.org/', c_custkey) ELSE '' END AS url, c_custkey % 3 = 0 AS is_core, c_custkey % 4 = 0 AS is_corecog
  FROM customer),
asked(selection, core, corecog) AS (VALUES ('all', false, false), ('core', true, false), ('corecog', false, true), ('both', true, true))
SELECT selection, name, url, is_core, is_corecog, (SELECT count(*) FROM rows) AS registered, (SELECT count(*) FROM rows WHERE is_core) AS n_core, (SELECT count(*) FROM rows WHERE is_corecog) AS n_corecog
FROM rows JOIN asked ON (is_core OR NOT core) AND (is_corecog OR NOT corecog) WHERE name <> '' AND url <> ''
""")
def stored_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a registry: those with a name and a URL, for each combination of the two flags, and how many are registered.

    Cells have white space around them; a flag is set by ``TRUE`` alone.
    """
    path, k = fresh_path(spark, "registry"), C("c_custkey")
    rows = _table(spark, sf_dir, "customer").select(
        F.when(k % 7 > 0, F.concat(F.lit(" "), "c_name")).otherwise("  ").alias("NAME"), F.when(k % 5 > 0, F.concat(F.lit("https://x.org/"), k.cast("string"), F.lit(" "))).alias("URL"),
        F.when(k % 4 == 0, "TRUE").otherwise("true").alias("CoreCog"), F.when(k % 3 == 0, " TRUE ").alias("CORE"),
    )
    rows.write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    registry = files.read_registry(spark, path)
    asked = {"all": (False, False), "core": (True, False), "corecog": (False, True), "both": (True, True)}
    picked = reduce(DataFrame.union, (files.registry_datasets(registry, *flags).withColumn("selection", F.lit(name)) for name, flags in asked.items()))
    counts = membership.registry_counts(registry).select("registered", C("core").alias("n_core"), C("corecog").alias("n_corecog"))
    return picked.join(counts).select("selection", "name", "url", "is_core", "is_corecog", "registered", "n_core", "n_corecog")  # counts: one row


_HEADERS = {**FORMS, "lacking": ("ID", "Language_ID"), "broken": ("ID", "Language_ID", "Parameter_ID")}
_EXPECTED = ("ID", "Parameter_ID", "Value", "Loan", "Source", "Cognacy", "Alignment", "Form")
_HELD = ", ".join(f"('{ds}', '{FAULTY.get(ds, ds)}', {list(header)})" for ds, header in _HEADERS.items())


@query(f"""
WITH headers(dataset, rows_of, header) AS (VALUES {_HELD}, ('elsewhere', NULL, [])),
placed AS (SELECT c_custkey, replace(lower(r_name), ' ', '') AS ds FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
sizes AS (SELECT ds, count(*) AS n FROM orders JOIN placed ON c_custkey = o_custkey GROUP BY ds)
SELECT dataset AS "Dataset", coalesce(n, 0) AS n_rows, {", ".join(f"list_contains(header, '{c}') AS has_{c}" for c in _EXPECTED)},
  array_to_string(list_filter({list(_EXPECTED)}, lambda c: NOT list_contains(header, c)), ',') AS absent
FROM headers LEFT JOIN sizes ON ds = rows_of
""")
def stored_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which columns the forms of each dataset have and lack, faulty datasets too; one that has no files has no column."""
    raw = normalize.column_flags(files.read_table(spark, write_datasets(spark, sf_dir), "forms.csv"), _EXPECTED)
    flags = [f"has_{c}" for c in _EXPECTED]
    told = raw.groupBy("Dataset", *flags, F.array_join(normalize.absent_columns(_EXPECTED), ",").alias("absent")).agg(F.count(F.lit(1)).alias("n_rows"))
    asked = spark.createDataFrame([(d,) for d in (*_HEADERS, "elsewhere")], "Dataset string")
    out = asked.join(told, "Dataset", "left")  # a dataset's columns by its name, none by default
    return out.select("Dataset", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), *(F.coalesce(c, F.lit(False)).alias(c) for c in flags), F.coalesce("absent", F.lit(",".join(_EXPECTED))).alias("absent"))


@query("""
WITH rows AS (SELECT concat('d', c_custkey // 50) AS ds, c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey // 50 % 4 <> 3)
SELECT concat(ds, '_K', c_custkey) AS "key", concat('@misc{', ds, '_K', c_custkey, ',', chr(10), '  note = {', c_name, ' {"} at', chr(10), '@home},', chr(10), '  journal = "', c_mktsegment, ' }"', chr(10), '}') AS "text",
  CAST(c_custkey % 50 + 1 AS BIGINT) AS after
FROM rows
UNION ALL SELECT DISTINCT NULL, concat('@string{jrn = "of ', ds, '"}'), CAST(0 AS BIGINT) FROM rows
""")
def stored_bibliography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as entries of bibliographies, fifty to a file: keyed by dataset, written as one file, read back from it.

    A field has a line that begins like an entry, another one a brace inside quotes; files begin with a string, and every
    fourth is blank. ``after`` counts the customers before an entry in its file.
    """
    entry = F.format_string('@misc{K%s,\n  note = {%s {"} at\n@home},\n  journal = "%s }"\n}', C("c_custkey").cast("string"), "c_name", "c_mktsegment")
    ds = F.concat(F.lit("d"), F.floor(C("c_custkey") / 50).cast("string"))
    held = _table(spark, sf_dir, "customer").groupBy(ds.alias("Dataset"), (F.floor(C("c_custkey") / 50) % 4 == 3).alias("blank")).agg(F.array_sort(F.collect_list(F.struct("c_custkey", entry.alias("e")))).alias("es"))
    text = F.concat(F.lit('@string{jrn = "of '), "Dataset", F.lit('"}\n'), F.array_join(C("es.e"), "  "))
    raw = held.select("Dataset", F.when(C("blank"), " \n\t").otherwise(text).alias("value"))
    rows = bibliography.rekeyed_entries(raw).select("Dataset", "pos", "text").union(raw.select("Dataset", F.lit(-1).cast("long"), F.lit(" \n ")))
    folder = fresh_path(spark, "bibliography")
    sinks.write_bibliography(rows, f"{folder}/sources.bib")
    back = spark.read.option("lineSep", "\n\n").text(f"{folder}/sources.bib").select(F.rtrim(F.regexp_replace("value", r"\n$", "")).alias("text"))
    key = bibliography.key_of(C("text"))
    return back.select(key.alias("key"), "text", F.when(key.isNull(), 0).otherwise(F.regexp_extract(key, r"_K(\d+)$", 1).cast("long") % 50 + 1).cast("long").alias("after"))


@query("""
SELECT concat('r_', doc_id) AS "ID", lang AS "Dataset", source AS "Comment", md5(concat(' "', text, chr(10))) AS text_md5, CAST(length(text) + 3 AS BIGINT) AS n, CASE WHEN doc_id % 3 > 0 THEN doc_id % 3 = 1 END AS "Loan", true AS same_file
FROM documents WHERE text IS NOT NULL
UNION ALL SELECT concat('r_', doc_id), lang, source, NULL, NULL, CASE WHEN doc_id % 3 > 0 THEN doc_id % 3 = 1 END, true FROM documents WHERE text IS NULL
""")
def stored_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as values of published forms, with a quote and white space around them: one CSV file of whole texts, read back with its types; ``same_file``: its length and hash are those that the writer told."""
    rows = _table(spark, sf_dir, "documents").select(F.concat(F.lit("r_"), C("doc_id").cast("string")).alias("ID"), C("lang").alias("Dataset"), F.concat(F.lit(' "'), "text", F.lit("\n")).alias("Value"), C("source").alias("Comment"), F.when(C("doc_id") % 3 > 0, C("doc_id") % 3 == 1).alias("Loan"))
    folder = fresh_path(spark, "texts")
    length, sha = sinks.export_csv(normalize.align(rows, FORMS_WRITTEN), f"{folder}/forms.csv")
    found = files.release_files(spark, folder).select(((C("length") == length) & (C("sha256") == sha) & (C("n_parts") == 1)).alias("same_file"))  # one row
    back = files.read_published(spark, f"{folder}/forms.csv", FORMS_WRITTEN)
    return back.join(F.broadcast(found)).select("ID", "Dataset", "Comment", F.md5("Value").alias("text_md5"), F.length("Value").cast("long").alias("n"), "Loan", "same_file")


@query("""
SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderpriority AS "Dataset"
FROM orders WHERE o_orderpriority <> '5-LOW' OR o_orderstatus = 'F'
""")
def stored_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in a folder for each priority, tried first and written twice; then one priority's folder is replaced by other rows."""
    path = fresh_path(spark, "orders")
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", C("o_orderpriority").alias("Dataset"))
    whole = rows.select("o_orderkey", "o_totalprice", "Dataset")
    sinks.dry_run(whole)
    for _ in range(2):
        sinks.write_table(whole, path)
    changed = rows.where("Dataset = '5-LOW' and o_orderstatus = 'F'")
    sinks.write_table(changed.select("o_orderkey", (C("o_totalprice") + 1).alias("o_totalprice"), "Dataset"), path)
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", "Dataset")
