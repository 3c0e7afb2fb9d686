"""Demo queries over what is stored and changes: datasets that come, change and go, and a ledger of releases."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaria.operators import release
from glossaria.sources.staging import delete, fresh_path
from glossaria.streaming import ingest

C = F.col
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _write(orders: DataFrame, customers: DataFrame, ds: str, root: str, value: str) -> None:
    """A dataset of one region: its orders as forms, its customers as languages."""
    to, own = f"{root}/{ds}/cldf", C("ds") == ds
    csv = lambda df, name: df.write.mode("overwrite").csv(f"{to}/{name}", header=True, escape='"', emptyValue="")
    csv(orders.where(own).select(C("o_orderkey").alias("ID"), C("o_custkey").alias("Language_ID"), C("o_orderpriority").alias("Parameter_ID"), C(value).alias("Value")), "forms.csv")
    csv(customers.where(own).select(C("c_custkey").alias("ID"), C("c_mktsegment").alias("Glottocode")), "languages.csv")
    csv(orders.where(own).select(C("o_orderpriority").alias("ID"), F.substring("o_orderpriority", 3, 99).alias("Concepticon_Gloss")).distinct(), "parameters.csv")
    customers.sparkSession.range(1).select(F.lit('{"dc:title": "' + ds + '"}').alias("value")).coalesce(1).write.mode("overwrite").text(f"{to}/cldf-metadata.json")


@query("""
WITH placed AS (SELECT c_custkey, c_mktsegment, lower(r_name) AS ds FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
kept AS (SELECT *, ds <> 'africa' AS late FROM orders JOIN placed ON c_custkey = o_custkey WHERE ds IN ('africa', 'asia', 'america'))
SELECT concat(ds, '_', o_orderkey) AS "ID", ds AS "Dataset", concat(ds, '_', o_custkey) AS "Language_ID", CASE WHEN late THEN o_orderpriority ELSE o_orderstatus END AS "Value", c_mktsegment AS "Glottocode",
  substring(o_orderpriority, 3) AS "Concepticon_Gloss", CAST(2 AS BIGINT) AS version
FROM kept WHERE late OR o_orderstatus <> 'P'
""")
def ingested_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms after a second ingest: of the three datasets of the first one, one has changed under the same path and one is gone; another has come."""
    t = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    customers = t("customer").join(t("nation"), C("n_nationkey") == C("c_nationkey")).join(t("region"), C("r_regionkey") == C("n_regionkey")).select("c_custkey", "c_mktsegment", F.lower("r_name").alias("ds"))
    orders = t("orders").join(customers.select("c_custkey", "ds"), C("o_custkey") == C("c_custkey"))
    root, target = fresh_path(spark, "arrivals"), fresh_path(spark, "ingested")
    early, late = (orders.where("o_orderstatus <> 'P'"), "o_orderstatus"), (orders, "o_orderpriority")
    with ThreadPool(3) as pool:  # small jobs, run side by side
        pool.map(lambda ds: _write(early[0], customers, ds, root, early[1]), ["africa", "asia", "europe"])
        ingest.ingest(spark, root, target)
        pool.map(lambda ds: _write(late[0], customers, ds, root, late[1]), ["asia", "america"])
    delete(spark, [f"{root}/europe"])
    version = ingest.ingest(spark, root, target)
    return ingest.read(spark, target).forms.select("ID", "Dataset", "Language_ID", "Value", "Glottocode", "Concepticon_Gloss", F.lit(version).cast("long").alias("version"))


@query("""
WITH told AS (SELECT 'A.20240101' AS version, * FROM documents UNION ALL SELECT 'A.20240202', * FROM documents WHERE lang <> 'en')
SELECT version, source AS collection, CAST(sum(strlen(text)) AS BIGINT) AS size, sha256(concat(count(*), '-', CAST(sum(CAST('0x' || md5(text)[1:8] AS BIGINT)) AS BIGINT))) AS sha256, concat('corpus.A.', source, '.', version[3:], '.zip') AS archive_name,
  CAST(3 AS BIGINT) AS stored, 1 AS refused
FROM told GROUP BY version, source
""")
def stored_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored ledger after two releases of the documents of each source, a third that is refused for its version, and the same by force."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), fresh_path(spark, "ledger")

    def manifest(rows: DataFrame, version: str) -> DataFrame:
        hashes = F.sum(F.conv(F.substring(F.md5("text"), 1, 8), 16, 10).cast("long"))  # texts of a source are not put together in one place
        held = rows.groupBy(C("source").alias("collection")).agg(F.sum(F.octet_length("text")).cast("long").alias("length"), F.sha2(F.concat_ws("-", F.count(F.lit(1)).cast("string"), hashes.cast("string")), 256).alias("sha256"))
        return release.manifest(held.withColumn("file_name", F.lit("documents.txt")), version)

    release.record_release(manifest(docs.where("lang = 'en'"), "A.20240101"), folder)
    release.record_release(manifest(docs.where("lang <> 'en'"), "A.20240202"), folder)
    refused = 0
    try:
        release.record_release(manifest(docs, "A.20240101"), folder)
    except ValueError:
        refused = 1
    release.record_release(manifest(docs, "A.20240101"), folder, force=True)
    number, ledger = release.load_ledger(spark, folder)
    return ledger.select("version", "collection", "size", "sha256", "archive_name", F.lit(number).cast("long").alias("stored"), F.lit(refused).alias("refused"))
