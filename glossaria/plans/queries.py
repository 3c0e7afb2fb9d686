"""Demo queries: the corpus operators over the given tables, each with the SQL that must give the same rows.

Datasets are stood in for by ``documents.source`` or a constant, forms by documents or orders, judgment files by
conversations or line items, languages by customers, parameters by parts, descriptors by events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaria.functions import descriptor, figures
from glossaria.functions import text as fn
from glossaria.operators import bibliography, enrich, judgments, membership, normalize, quality, release
from glossaria.plans import file_queries, sink_queries, store_queries
from glossaria.plans.corpus import numbered
from glossaria.schemas import LANGUAGES
from glossaria.sources.staging import fresh_path
from glossaria.streaming import ingest

QUERIES: dict = {}
SQL: dict[str, str] = {}

C = F.col
#: Files that the events are dealt out to where they stand in for a stream.
MICRO_BATCHES = 4


def query(sql: str):
    """Registers a function of a table reader under its name, with its SQL."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[f.__name__], SQL[f.__name__] = run, sql
        return f

    return add


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate"]
_LINE_SQL = ", ".join(LINE_ORDER)


@query(f"""
WITH gathered AS (
  SELECT l_orderkey, arg_min(l_partkey, ({_LINE_SQL})) AS part, string_agg(concat('orders_', l_returnflag, l_linenumber), ';' ORDER BY {_LINE_SQL}) AS sets,
    arg_min(l_linestatus, ({_LINE_SQL})) FILTER (l_linestatus <> 'F') AS Alignment, arg_min(l_returnflag, ({_LINE_SQL})) FILTER (l_returnflag = 'R') AS Cognate_Source
  FROM lineitem GROUP BY l_orderkey)
SELECT concat('orders_', o_orderkey) AS ID, 'orders' AS Dataset, concat('orders_', o_custkey) AS Language_ID, o_orderpriority AS Value,
  nullif(concat_ws(';', CASE WHEN o_orderstatus = 'O' THEN concat('orders_', o_orderstatus) END, sets), '') AS Cognacy,
  Alignment, Cognate_Source, c_mktsegment AS Glottocode, n_name AS Glottolog_Name, 'orders_' || part AS Parameter_ID, p_brand AS Concepticon_ID, p_name AS Concepticon_Gloss
FROM orders LEFT JOIN gathered ON l_orderkey = o_orderkey LEFT JOIN (customer JOIN nation ON n_nationkey = c_nationkey) ON c_custkey = o_custkey
LEFT JOIN part ON p_partkey = part AND p_size > 10
""")
def enriched_forms(t):
    d = F.lit("orders")
    forms = t("orders").select(
        fn.prefix_id(d, C("o_orderkey").cast("string")).alias("ID"), d.alias("Dataset"), fn.prefix_id(d, C("o_custkey").cast("string")).alias("Language_ID"), C("o_orderpriority").alias("Value"),
        fn.prefix_value(d, F.when(C("o_orderstatus") == "O", C("o_orderstatus"))).alias("Cognacy"),
    )
    judged = t("lineitem").select(
        d.alias("Dataset"), fn.prefix_id(d, C("l_orderkey").cast("string")).alias("ID"), *LINE_ORDER, F.concat(F.lit("orders_"), "l_returnflag", C("l_linenumber").cast("string")).alias("set"),
        F.nullif("l_linestatus", F.lit("F")).alias("Alignment"), F.when(C("l_returnflag") == "R", C("l_returnflag")).alias("Source"), fn.prefix_id(d, C("l_partkey").cast("string")).alias("part"),
    )
    languages = t("customer").join(t("nation"), C("c_nationkey") == C("n_nationkey")).select(
        fn.prefix_id(d, C("c_custkey").cast("string")).alias("ID"), C("c_mktsegment").alias("Glottocode"), C("n_name").alias("Glottolog_Name")
    )
    gathered = judgments.aggregate(judged, ["Dataset", "ID"], LINE_ORDER, {"set": "sets"}, {"Alignment": "Alignment", "Source": "Cognate_Source", "part": "Parameter_ID"})
    out = judgments.attach(forms, gathered, ["Dataset", "ID"]).withColumn("Cognacy", judgments.cognacy(C("Cognacy"), C("sets"))).drop("sets")
    out = enrich.attach_parent(out, languages, "Language_ID", "ID", ["Glottocode", "Glottolog_Name"])
    parameters = t("part").where("p_size > 10").select(fn.prefix_id(d, C("p_partkey").cast("string")).alias("ID"), C("p_brand").alias("Concepticon_ID"), C("p_name").alias("Concepticon_Gloss"))
    return enrich.attach_parent(out, parameters, "Parameter_ID", "ID", ["Concepticon_ID", "Concepticon_Gloss"])


@query("""
SELECT conv_id, string_agg(role, ';' ORDER BY turn) AS roles, arg_min(text, turn) FILTER (role = 'assistant') AS first_reply,
  nullif(concat_ws(';', arg_min(role, turn) FILTER (role = 'system'), string_agg(role, ';' ORDER BY turn)), '') AS combined
FROM conversations GROUP BY conv_id
""")
def ordered_judgments(t):
    said = t("conversations").withColumn("reply", F.when(C("role") == "assistant", C("text"))).withColumn("instructor", F.when(C("role") == "system", C("role")))
    out = judgments.aggregate(said, ["conv_id"], ["turn"], {"role": "roles"}, {"reply": "first_reply", "instructor": "instructor"})
    return normalize.combine(out, ["instructor", "roles"], "combined").drop("instructor")


@query("SELECT doc_id, source AS \"Dataset\", concat(source, '_', doc_id) AS ID, concat(source, '_', lang) AS Language_ID FROM documents")
def prefix_ids(t):
    docs = t("documents").select("doc_id", C("source").alias("Dataset"), C("doc_id").cast("string").alias("ID"), C("lang").alias("Language_ID"))
    return normalize.prefix_ids(docs, ["ID", "Language_ID"])


@query("""
SELECT p_partkey, nullif(array_to_string(list_transform(list_filter(list_transform(string_split(p_name, ' '), lambda k: trim(k)), lambda k: k <> ''), lambda k: concat(p_brand, '_', k)), ' '), '') AS keys
FROM part
""")
def prefix_key_list(t):
    part = t("part").select("p_partkey", C("p_name").alias("keys"), C("p_brand").alias("Dataset"))
    return normalize.prefix_key_list(part, ["keys"], sep=" ").drop("Dataset")


@query("""
SELECT l_returnflag AS flag, CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS loan, count(*) AS n_rows FROM lineitem GROUP BY 1, 2
""")
def decode_boolean(t):
    told = t("lineitem").select(C("l_returnflag").alias("flag"), F.when(C("l_returnflag") == "R", "true").when(C("l_returnflag") == "A", "false").otherwise("True").alias("loan"))
    return normalize.decode_boolean(told, ["loan"]).groupBy("flag", "loan").agg(F.count(F.lit(1)).alias("n_rows"))


@query(r"""
SELECT page_id, nullif(regexp_extract(url, 'page=([^&#]*)', 1), '') AS shown, try_cast(nullif(regexp_extract(url, 'page=([0-9]+)', 1), '') AS DOUBLE) AS page,
  try_cast(nullif(regexp_extract(url, '/([0-9]+)(\.html|[/?#]|$)', 1), '') AS DOUBLE) AS number
FROM pages
""")
def coerce_number(t):
    pages = t("pages").select("page_id", F.regexp_extract("url", "page=([^&#]*)", 1).alias("shown"), F.regexp_extract("url", r"/([0-9]+)(\.html|[/?#]|$)", 1).alias("number"))
    return normalize.coerce_number(normalize.empty_to_null(pages.withColumn("page", C("shown"))), ["page", "number"])


@query("""
SELECT concat('c', c_custkey) AS ID, 'customer' AS "Dataset", c_name AS Name, c_mktsegment AS Family, CAST(NULL AS VARCHAR) AS Remark, c_acctbal AS Latitude FROM customer
UNION ALL SELECT concat('s', s_suppkey), 'supplier', s_name, NULL, NULL, s_acctbal FROM supplier
""")
def align_schema_union(t):
    a = t("customer").select(F.concat(F.lit("c"), C("c_custkey").cast("string")).alias("ID"), F.lit("customer").alias("Dataset"), C("c_name").alias("Name"), C("c_mktsegment").alias("Family"), C("c_acctbal").alias("Latitude"), "c_nationkey")
    b = t("supplier").select(C("s_acctbal").alias("Latitude"), C("s_name").alias("Name"), F.lit("supplier").alias("Dataset"), F.concat(F.lit("s"), C("s_suppkey").cast("string")).alias("ID"))
    both = membership.union_all([normalize.align(a, LANGUAGES), normalize.align(b, LANGUAGES)])
    return both.select("ID", "Dataset", "Name", "Family", "Remark", "Latitude")


@query("""
SELECT o_orderkey, o_custkey AS custkey, CASE WHEN o_orderstatus = 'F' THEN nullif(o_orderpriority, '1-URGENT') ELSE c_mktsegment END AS segment, c_name AS name
FROM orders LEFT JOIN customer ON c_custkey = o_custkey
""")
def left_wins_join(t):
    orders = t("orders").select("o_orderkey", C("o_custkey").alias("custkey"), F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("segment"), C("o_orderstatus").alias("file"))
    customers = t("customer").select(C("c_custkey").alias("custkey"), C("c_mktsegment").alias("segment"), C("c_name").alias("name"))
    return judgments.attach(orders, customers, ["custkey"], {"segment": C("file") == "F"}).drop("file")


@query("""
SELECT d.doc_id, nullif(concat_ws(';', source || '_' || nullif(lang, 'en'), CAST(quality AS VARCHAR)), '') AS Cognacy FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def combine_values(t):
    docs = t("documents").select("doc_id", fn.prefix_value(C("source"), F.nullif("lang", F.lit("en"))).alias("own")).join(t("labels").select("doc_id", C("quality").cast("string").alias("judged")), "doc_id", "left")
    return normalize.combine(docs, ["own", "judged"], "Cognacy").select("doc_id", "Cognacy")


@query("""
SELECT page_id, concat('@misc{d', page_id % 5, '_p', page_id, ', url={', url, '}}', chr(10), '@comment{note, x}', chr(10), '@Article{d', page_id % 5, '_k', page_id, ',}') AS value, CAST(3 + length(url) - length(replace(url, '@', '')) AS BIGINT) AS at_signs, CAST(2 AS BIGINT) AS n_entries FROM pages
""")
def rekey_entries(t):
    i = C("page_id").cast("string")
    texts = t("pages").select("page_id", F.concat(F.lit("d"), (C("page_id") % 5).cast("string")).alias("Dataset"), F.concat(F.lit("@misc{p"), i, F.lit(", url={"), "url", F.lit("}}\n@comment{note, x}\n@Article{k"), i, F.lit(",}")).alias("value"))
    out = bibliography.rekey(texts)
    n = bibliography.entries(out.withColumn("Dataset", i)).groupBy(C("Dataset").cast("long").alias("page_id")).agg(F.count("key").alias("n_entries"))
    return out.withColumn("at_signs", fn.count_character(C("value"), "@")).drop("Dataset").join(n, "page_id")


@query("""
WITH t AS (SELECT page_id, concat('d', page_id % 3) AS ds, url FROM pages)
SELECT page_id, 0 AS pos, CAST(NULL AS VARCHAR) AS key, concat('% of page ', page_id) AS text FROM t
UNION ALL SELECT page_id, 1, NULL, concat('@string{site = "', url, '"}') FROM t
UNION ALL SELECT page_id, 3, concat(ds, '_a', page_id), concat('@misc{', ds, '_a', page_id, ', note={mail to', chr(10), '@home now {and then}}, url="', url, ' } {@x{y, "}"}"', chr(10), '}') FROM t
UNION ALL SELECT page_id, 5, concat(ds, '_b', page_id), concat('@Book(', ds, '_b', page_id, ', title={a) "b}, note = site # "(c)")') FROM t
UNION ALL SELECT page_id, 6, NULL, '@comment{@misc{c, note={d}}}' FROM t
""")
def entry_texts(t):
    """Every part of a bibliography as a text of its own: nested braces, quotations, entries that share a line, and lines that begin with an ``@``."""
    i, url = C("page_id").cast("string"), C("url")
    text = F.concat(
        F.lit("% of page "), i, F.lit('\n@string{site = "'), url, F.lit('"}\n\n@misc{a'), i, F.lit(', note={mail to\n@home now {and then}}, url="'), url, F.lit(' } {@x{y, "}"}"\n} @Book(b'), i,
        F.lit(', title={a) "b}, note = site # "(c)")@comment{@misc{c, note={d}}}\n'),
    )
    texts = t("pages").select("page_id", F.concat(F.lit("d"), (C("page_id") % 3).cast("string")).alias("Dataset"), text.alias("value"))
    parts = bibliography.rekeyed_entries(texts.withColumn("Dataset", F.concat_ws("|", "Dataset", i)))  # a text for each page
    key = F.concat(F.substring_index("Dataset", "|", 1), F.lit("_"), F.substring_index("key", "_", -1))
    whole = F.replace("text", F.concat(F.lit("|"), F.substring_index("Dataset", "|", -1), F.lit("_")), F.lit("_"))
    return parts.select(F.substring_index("Dataset", "|", -1).cast("long").alias("page_id"), C("pos").cast("int").alias("pos"), F.when(C("key").isNotNull(), key).alias("key"), whole.alias("text"))


@query("""
SELECT event_id, event_type AS "Title", event_type AS "CLDF_Module", CASE WHEN user_id % 3 = 0 THEN 0 ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS "Form_Count",
  concat('v', user_id % 7) AS "Repository_Version", CASE WHEN user_id % 2 = 0 THEN concat('v', user_id % 5) END AS "Glottolog_Version", CAST(NULL AS VARCHAR) AS "CLTS_Version"
FROM events
""")
def extract_descriptor(t):
    user = lambda n: (C("user_id") % n).cast("string")
    item = lambda title, v: F.concat(F.lit('{"dc:title":"' + title + '","dc:created":"v'), v, F.lit('"}'))
    told = t("events").select(
        C("event_id").cast("string").alias("Dataset"),
        F.concat(
            F.lit('{"dc:title":"'), "event_type", F.lit('","dc:conformsTo":"http://x.org/terms#'), "event_type", F.lit('","tables":[{"dc:conformsTo":null},{"dc:conformsTo":"x#'),
            F.when(C("user_id") % 3 == 0, "Other").otherwise("Form"), F.lit('Table","dc:extent":'), F.get_json_object("props", "$.k"), F.lit('}],"prov:wasDerivedFrom":['),
            F.when(C("user_id") % 2 == 0, F.concat(item("Glottolog", user(5)), F.lit(","))).otherwise(""), item("Repository", user(7)), F.lit("]}"),
        ).alias("value"),
    )
    both = descriptor.described(told).select("Dataset", *descriptor.metadata_columns(F.lit(False)), *descriptor.reference_columns())
    return both.select(C("Dataset").cast("long").alias("event_id"), "Title", "CLDF_Module", "Form_Count", "Repository_Version", "Glottolog_Version", "CLTS_Version")


def _labelled(t) -> DataFrame:
    return t("documents").select("doc_id", "source", "lang").join(t("labels"), "doc_id", "left")


@query("""
SELECT source, round_even(100 * count(*) FILTER (quality IS NULL) / count(*), 1) AS quality_null_pct, round_even(100 * count(*) FILTER (toxic IS NULL) / count(*), 1) AS toxic_null_pct
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source
""")
def null_percentage(t):
    return quality.null_percentage(_labelled(t), ["source"], ["quality", "toxic"])


@query("""
SELECT count(*) AS n_rows, round_even(100 * count(quality) / count(*), 2) AS quality_pct, round_even(100 * count(nullif(toxic, 0)) / count(*), 2) AS toxic_pct FROM documents LEFT JOIN labels USING (doc_id)
""")
def coverage(t):
    return quality.coverage(_labelled(t).withColumn("toxic", F.nullif("toxic", F.lit(0))), ["quality", "toxic"])


def _stand_in(t) -> DataFrame:
    """Per-dataset figures of documents as forms, languages as languages and labelled documents as parameters."""
    docs = _labelled(t).withColumnRenamed("source", "Dataset")
    only = lambda c, out: F.nullif(c, F.lit(0)).cast("string").alias(out)
    forms = docs.select(
        "Dataset", only("quality", "Glottocode"), only("toxic", "Concepticon_ID"), C("quality").cast("string").alias("Cognacy"), F.nullif("lang", F.lit("en")).alias("Segments"), only("toxic", "Alignment"),
        C("toxic").cast("string").alias("Comment"), (C("quality") == 1).alias("Loan"), F.when(C("Dataset") == "src3", C("lang")).alias("Morpheme_Index"), F.when(C("Dataset").isin("src3", "src4"), C("lang")).alias("Segment_Slice"),
    )
    named = t("documents").select(C("source").alias("Dataset")).distinct().withColumn("Has_Cognates", C("Dataset").startswith("src1"))
    return quality.dataset_stats(forms, docs.select("Dataset", "lang").distinct(), docs.where("quality is not null").select("Dataset"), named)


@query("""
SELECT source AS "Dataset", count(*) AS forms, count(DISTINCT lang) AS languages, count(quality) AS parameters, starts_with(source, 'src1') AS has_cognates,
  round_even(100 * count(*) FILTER (lang = 'en') / count(*), 1) AS "Segments_null_pct", round_even(100 * count(*) FILTER (toxic IS NULL) / count(*), 1) AS "Comment_null_pct",
  round_even(100 * count(*) FILTER (quality IS NULL) / count(*), 1) AS "Loan_null_pct", round_even(100 * count(*) FILTER (quality IS NULL) / count(*), 1) AS "Cognacy_null_pct",
  round_even(100 * count(*) FILTER (coalesce(toxic, 0) = 0) / count(*), 1) AS "Alignment_null_pct"
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source
""")
def completeness(t):
    return quality.completeness(_stand_in(t))


@query("""
SELECT CAST(count(DISTINCT source) AS BIGINT) AS total_datasets, count(*) AS total_forms, CAST(count(DISTINCT concat(source, lang)) AS BIGINT) AS total_languages, count(quality) AS total_parameters,
  count(DISTINCT source) FILTER (starts_with(source, 'src1')) AS datasets_with_cognates,
  count(DISTINCT source) FILTER (source = 'src3') + count(DISTINCT source) FILTER (source IN ('src3', 'src4')) AS datasets_with_partial_cognacy,
  coalesce(string_agg(DISTINCT source, ';' ORDER BY source) FILTER (source IN ('src3', 'src4')), '') AS segment_slice_datasets, count(*) FILTER (source IN ('src3', 'src4')) AS forms_with_segment_slice,
  round_even(100 * count(nullif(quality, 0)) / count(*), 2) AS glottocode_coverage_percent, round_even(100 * count(quality) / count(*), 2) AS forms_with_cognate_data_percent
FROM documents LEFT JOIN labels USING (doc_id)
""")
def quality_report(t):
    out = quality.rollup(_stand_in(t))
    named = F.array_join("datasets_with_segment_slice", ";").alias("segment_slice_datasets")
    return out.select("total_datasets", "total_forms", "total_languages", "total_parameters", "datasets_with_cognates", "datasets_with_partial_cognacy", named, "forms_with_segment_slice", "glottocode_coverage_percent", "forms_with_cognate_data_percent")


def _versions(t) -> DataFrame:
    return quality.version_distribution(t("lineitem").select(C("l_returnflag").alias("a"), F.nullif("l_linestatus", F.lit("F")).alias("b")), {"a": "glottolog", "b": "concepticon"})


@query("""
SELECT 'glottolog' AS system, l_returnflag AS version, count(*) AS datasets FROM lineitem GROUP BY 2
UNION ALL SELECT 'concepticon', l_linestatus, count(*) FROM lineitem WHERE l_linestatus <> 'F' GROUP BY 2
""")
def version_distribution(t):
    return _versions(t)


@query("""
SELECT 'glottolog' AS system, CASE WHEN min(l_returnflag) = max(l_returnflag) THEN min(l_returnflag) ELSE concat(min(l_returnflag), '-', max(l_returnflag)) END AS versions FROM lineitem
UNION ALL SELECT 'concepticon', CASE WHEN min(l_linestatus) = max(l_linestatus) THEN min(l_linestatus) ELSE concat(min(l_linestatus), '-', max(l_linestatus)) END FROM lineitem WHERE l_linestatus <> 'F'
""")
def version_range(t):
    return release.version_range(_versions(t))


@query("""
SELECT (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)) AS orphan_language_ids,
  (SELECT count(DISTINCT o_orderkey) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 10)) AS orphan_parameter_ids,
  (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS forms_without_glottocode, (SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT') AS forms_without_concepticon_id
""")
def orphan_keys(t):
    forms = t("orders").select(C("o_custkey").alias("Language_ID"), C("o_orderkey").alias("Parameter_ID"), F.nullif("o_orderstatus", F.lit("F")).alias("Glottocode"), F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("Concepticon_ID"))
    return enrich.integrity(forms, t("customer").where("c_acctbal > 0").select(C("c_custkey").alias("ID")), t("lineitem").where("l_quantity > 10").select(C("l_orderkey").alias("ID")))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(t):
    return enrich.duplicate_keys(t("lineitem"), ["l_orderkey", "l_linenumber"])


_MULTIPLE = """
per AS (SELECT conv_id, count(*) AS n_judgments, count(DISTINCT length(text) % 3) AS n_kind, string_agg(CAST(turn AS VARCHAR), ';' ORDER BY turn) AS turns FROM conversations WHERE role = 'user' GROUP BY conv_id)
"""


@query(f"""
WITH {_MULTIPLE}, forms AS (SELECT DISTINCT conv_id FROM conversations)
SELECT f.conv_id, p.turns, length(c.text) % 3 AS kind, c.turn AS turn FROM forms f JOIN per p USING (conv_id) JOIN conversations c ON c.conv_id = f.conv_id AND c.role = 'user' WHERE p.n_kind > 1
UNION ALL
SELECT f.conv_id, p.turns, (SELECT arg_min(length(c.text) % 3, c.turn) FROM conversations c WHERE c.conv_id = f.conv_id AND c.role = 'user'), (SELECT min(turn) FROM conversations c WHERE c.conv_id = f.conv_id AND c.role = 'user')
FROM forms f LEFT JOIN per p USING (conv_id) WHERE coalesce(p.n_kind, 0) <= 1
""")
def row_multiplication(t):
    said = t("conversations")
    judged = said.where(C("role") == "user").select("conv_id", "turn", (F.length("text") % 3).cast("long").alias("kind"))
    return judgments.multiply(said.select("conv_id").distinct(), judged, ["conv_id"], ["turn"], ["kind"], "turn", "turns", {"kind": "kind", "turn": "turn"})


@query(f"WITH {_MULTIPLE} SELECT conv_id, n_judgments, n_kind, n_kind > 1 AS varies FROM per")
def judgment_multiplicity(t):
    return judgments.multiplicity(t("conversations").where(C("role") == "user").select("conv_id", (F.length("text") % 3).alias("kind")), ["conv_id"], ["kind"])


@query("""
SELECT DISTINCT p_brand AS "Dataset", k.key FROM part, unnest(string_split(p_name, ' ')) AS k(key)
WHERE k.key <> '' AND (p_brand, k.key) NOT IN (SELECT p_brand, x.key FROM part, unnest(string_split(p_name, ' ')) AS x(key) WHERE p_size > 25)
""")
def citation_integrity(t):
    part = t("part").select(C("p_brand").alias("Dataset"), F.replace("p_name", F.lit(" "), F.lit(";")).alias("Source"), "p_size")
    known = part.where("p_size > 25").select("Dataset", F.explode(fn.key_list(C("Source"))).alias("key"))
    return bibliography.unresolved(part, known)


@query(r"""
WITH p AS (SELECT regexp_extract(url, 'example\.(\w+)', 1) AS site, regexp_extract(url, '#(.*)$', 1) AS fragment, regexp_extract(url, '\?([^#]*)', 1) AS query FROM pages)
SELECT site, 'fragment' AS "column", count(*) FILTER (site <> 'net' AND fragment <> '') AS filled, count(*) FILTER (site <> 'net' AND fragment = '') AS empty, count(*) FILTER (site = 'net') AS absent FROM p GROUP BY site
UNION ALL SELECT site, 'query', count(*) FILTER (query <> ''), count(*) FILTER (query = ''), 0 FROM p GROUP BY site
""")
def missing_split(t):
    pages = t("pages").select(F.regexp_extract("url", r"example\.(\w+)", 1).alias("site"), F.regexp_extract("url", "#(.*)$", 1).alias("fragment"), F.regexp_extract("url", r"\?([^#]*)", 1).alias("query"))
    pages = pages.withColumn("header", F.when(C("site") == "net", F.array(F.lit("query"))).otherwise(F.array(F.lit("query"), F.lit("fragment"))))
    return quality.missing_split(pages, ["site"], ["fragment", "query"], "header")


@query("SELECT doc_id, n_chars AS declared, CAST(length(text) AS BIGINT) AS counted, n_chars = length(text) AS declared_agrees FROM documents")
def declared_vs_actual(t):
    docs = t("documents")
    return quality.declared_against_actual(docs.select("doc_id", C("n_chars").alias("declared")), docs.select("doc_id", F.length("text").cast("long").alias("counted")), ["doc_id"], {"declared": "counted"})


def _registry(t) -> DataFrame:
    """Datasets named by their number: every second one is core, every third one corecog."""
    n = F.regexp_extract("name", "([0-9]+)$", 1).cast("int")
    return t("documents").select(C("source").alias("name")).distinct().select("name", (n % 2 == 0).alias("is_core"), (n % 3 == 0).alias("is_corecog"))


@query("SELECT doc_id, source AS \"Dataset\", lang FROM documents WHERE CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT) % 6 = 0")
def collection_members(t):
    docs = t("documents").select("doc_id", C("source").alias("Dataset"), "lang")
    return membership.members(membership.members(docs, _registry(t), "is_core"), _registry(t), "is_corecog").select("doc_id", "Dataset", "lang")


@query("""
WITH d AS (SELECT source, lang, n_chars, CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT) AS n FROM documents)
SELECT 'forms' AS metric, count(*) AS "full", count(*) FILTER (n % 2 = 0) AS core, count(*) FILTER (n % 3 = 0) AS corecog FROM d
UNION ALL SELECT 'datasets', count(DISTINCT source), count(DISTINCT source) FILTER (n % 2 = 0), count(DISTINCT source) FILTER (n % 3 = 0) FROM d
UNION ALL SELECT 'chars', CAST(sum(n_chars) AS BIGINT), CAST(sum(n_chars) FILTER (n % 2 = 0) AS BIGINT), CAST(sum(n_chars) FILTER (n % 3 = 0) AS BIGINT) FROM d
""")
def collection_pivot(t):
    per = t("documents").groupBy(C("source").alias("Dataset")).agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("c"))
    routed = membership.explode_memberships(per, _registry(t))
    rolled = routed.groupBy("collection").agg(F.sum("n").alias("forms"), F.count(F.lit(1)).alias("datasets"), F.sum("c").alias("chars"))
    return membership.compare(rolled, ["forms", "datasets", "chars"])


@query("""
SELECT source AS "Dataset", quality, toxic, doc_id, row_number() OVER (ORDER BY source NULLS LAST, quality NULLS LAST, toxic NULLS LAST, doc_id NULLS LAST) AS place FROM documents LEFT JOIN labels USING (doc_id)
""")
def sorted_nulls_last(t):
    docs = _labelled(t).select(C("source").alias("Dataset"), "quality", "toxic", "doc_id")
    return numbered(docs, ["quality", "toxic", "doc_id"], "place")


@query("""
SELECT doc_id, source, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND regexp_matches(text, '[Tt]he \\w+ing') 
""".replace("\\\\", "\\"))
def user_filters(t):
    docs = t("documents").select("doc_id", "source", "text").join(t("labels").select("doc_id", "quality"), "doc_id", "left")
    return docs.where(C("quality").isNotNull() & fn.contains_pattern(C("text"), r"[Tt]he \w+ing")).select("doc_id", "source", "quality")


@query("""
SELECT concat('text.', doc_id) AS file_name, concat('text_', doc_id) AS file_key, CAST(strlen(text) AS BIGINT) AS size,
  CASE WHEN strlen(text) < 1024 THEN printf('%d B', strlen(text)) WHEN strlen(text) < 1048576 THEN printf('%.0f KB', strlen(text) / 1024) ELSE printf('%.0f MB', strlen(text) / 1048576) END AS size_shown,
  sha256(text) AS sha256, concat('corpus.A.', source, '.20240101.zip') AS archive_name, concat('corpus-A-', source, '-20240101') AS directory_name,
  format('{:,}', n_chars) AS chars_shown, CAST(length(text) - length(replace(text, '@', '')) AS BIGINT) AS at_signs
FROM documents
""")
def content_manifest(t):
    docs = t("documents").select("text", "n_chars", C("source").alias("collection"), F.concat(F.lit("text."), C("doc_id").cast("string")).alias("file_name"), F.octet_length("text").cast("long").alias("length"), figures.content_hash(C("text")).alias("sha256"))
    shown = docs.select("file_name", figures.thousands(C("n_chars")).alias("chars_shown"), fn.count_character(C("text"), "@").alias("at_signs"))
    listed = release.manifest(docs.select("collection", "file_name", "length", "sha256"), "A.20240101")
    return listed.drop("version", "collection").join(shown, "file_name")


@query("SELECT n_name AS name FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900)")
def release_gate(t):
    needed = t("nation").select(C("n_name").alias("name"), C("n_nationkey").alias("key"))
    found = t("customer").where("c_acctbal > 9900").select(C("c_nationkey").alias("key"))
    return needed.join(release.gate(needed, found, ["key"]), "key").select("name")


SQL["incremental_stats"] = "SELECT event_type, count(*) AS n_rows, count(value) AS n_value, count(props) AS n_props FROM events GROUP BY event_type"


SQL["windowed_stats"] = "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n_rows, count(value) AS n_value FROM events GROUP BY ALL"


def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of several files, a micro-batch for each, so that state goes on from one to the next."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    path = fresh_path(spark, "events")
    events.repartition(MICRO_BATCHES).write.parquet(path)
    return ingest.read_stream(spark, path, events.schema)


def _incremental_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events counted over micro-batches; the last state is the result."""
    out = fresh_path(spark, "running-stats")
    ingest.run_to_table(ingest.running_stats(_streamed(spark, sf_dir), ["event_type"], ["value", "props"]), f"{out}/table", f"{out}/state")
    return spark.read.parquet(f"{out}/table")


def _windowed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events counted by day over micro-batches, all days kept."""
    out = fresh_path(spark, "windowed-stats")
    rows = _streamed(spark, sf_dir).withColumn("ts", C("ts").cast("timestamp"))
    ingest.run_to_table(ingest.windowed_stats(rows, "ts", "1 day", "2 days", ["event_type"], ["value"]), f"{out}/table", f"{out}/state")
    return spark.read.parquet(f"{out}/table").select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n_rows", "n_value")


SQL["revised_stats"] = """
WITH e AS (SELECT *, CAST(user_id % 3 AS INTEGER) AS revision, user_id % 17 AS dataset FROM events WHERE user_id % 17 <> user_id % 3)
SELECT CAST(dataset AS BIGINT) AS dataset, max(revision) AS revision, count(*) AS n_rows, count(value) AS n_value, (SELECT count(*) FROM e x WHERE revision = (SELECT max(revision) FROM e y WHERE y.dataset = x.dataset)) AS n_all
FROM e WHERE revision = (SELECT max(revision) FROM e z WHERE z.dataset = e.dataset) GROUP BY dataset
"""


def _revised_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events counted over micro-batches by a number of their user as dataset; rows of an older revision, early or late, count no more."""
    out = fresh_path(spark, "revised-stats")
    rows = _streamed(spark, sf_dir).withColumns({"revision": (C("user_id") % 3).cast("int"), "dataset": (C("user_id") % 17).cast("long")}).where("dataset <> revision")
    ingest.run_revised(rows, f"{out}/table", f"{out}/state", "dataset", "revision", ["value"])
    held = ingest.read_revised(spark, f"{out}/table")
    return held.join(held.agg(F.sum("n_rows").alias("n_all"))).select("dataset", "revision", "n_rows", "n_value", "n_all")  # one row


QUERIES.update(file_queries.QUERIES | store_queries.QUERIES | sink_queries.QUERIES)
SQL.update(file_queries.SQL | store_queries.SQL | sink_queries.SQL)
QUERIES["incremental_stats"] = _incremental_stats
QUERIES["windowed_stats"] = _windowed_stats
QUERIES["revised_stats"] = _revised_stats
