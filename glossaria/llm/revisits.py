"""WARC revisits: not-modified records take their payload from the latest earlier full response.

An as-of join by canonical URL in steps, so that a URL which holds a third of all captures does not meet in one sort:
time is cut into slices; inside a slice a window finds the latest response before each revisit, and each slice hands on
only its last response. What finds none looks among the slices of its span, and each span again hands on only its last
response. So a task sorts the captures of one URL and hour, the slices of one span, or the spans of one URL (some 34 a year).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossaria.llm.common import LOWER, UPPER, table
from glossaria.llm.url_filter import OP1_SQL, canonical_url, host_of, path_of

#: Seconds of a time slice.
SLICE_SECONDS = 3600
#: Slices of a span.
SPAN_SLICES = 256
#: Headers of a 304 response that may replace those of the stored response (RFC 9110, section 15.4.5; RFC 9111, 3.2).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def lower_keys(headers: Column) -> Column:
    """Header names in lower case, null values dropped; of names that differ in case only, the last stays."""
    pairs = F.filter(F.map_entries(headers), lambda e: e["value"].isNotNull())
    return F.aggregate(
        pairs, F.create_map().cast("map<string,string>"),
        lambda acc, e: F.map_concat(F.map_filter(acc, lambda k, _: k != F.lower(F.trim(e["key"]))), F.create_map(F.lower(F.trim(e["key"])), e["value"])),
    )


def opaque_tag(tag: Column) -> Column:
    """An entity tag for the weak comparison: without ``W/``."""
    return F.regexp_replace(F.trim(tag), "^W/", "")


def _before(ends: DataFrame, asked: DataFrame, by: list[str], place: str) -> DataFrame:
    """``asked`` with ``far``: the ``end`` of the greatest smaller ``place`` among those of the same ``by``; null without one."""
    asking = asked.withColumn("end", F.lit(None).cast(ends.schema["end"].dataType)).withColumn("asks", F.lit(True))
    earlier = Window.partitionBy(*by).orderBy(place).rangeBetween(Window.unboundedPreceding, -1)
    steps = ends.withColumn("asks", F.lit(False)).unionByName(asking)
    return steps.withColumn("far", F.last("end", ignorenulls=True).over(earlier)).where("asks").select(*by, *([place] if place not in by else []), "far")


def resolve_revisits(records: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Resolves every revisit in ``records``.

    Input: ``record_id`` (long), ``url``, ``at`` (seconds, long), ``kind`` (``response`` or ``revisit``; other rows are
    not read), ``headers`` (map of strings), ``digest`` (of the payload; null if unknown). Other columns are not read.

    A row per revisit: ``record_id``, ``canon``, ``at``, ``source_id`` (the latest response of the canonical URL before it:
    smaller ``at``, or the same and a smaller ``record_id``; null if none), ``source_at``, ``status``, ``headers``.
    ``status`` is ``missing`` without such a response, or if url, time or id is null; ``matched`` if the first validator
    that both have agrees (payload digest, then entity tag by weak comparison, then Last-Modified); ``mismatch`` if
    it differs; ``unchecked`` if they share none. Headers are those of the response, replaced by the revisit's permitted
    ones, where the status is matched or unchecked; else the revisit's own. Rows that repeat are resolved each.
    """
    kept = records.where(F.col("kind").isin("response", "revisit")).select(
        "record_id", canonical_url(F.col("url")).alias("canon"), F.col("at").cast("long").alias("at"),
        (F.col("kind") == "response").alias("full"), lower_keys(F.coalesce("headers", F.create_map().cast("map<string,string>"))).alias("headers"), "digest",
    )
    whole = F.col("canon").isNotNull() & F.col("at").isNotNull() & F.col("record_id").isNotNull()
    usable = kept.where(whole).withColumn("slice", F.floor(F.col("at") / slice_seconds)).withColumn("state", F.when(F.col("full"), F.struct("at", "record_id", "digest", "headers")))
    # With the flag in front, a response stands after a revisit of the same time and id; ids differ in sound input.
    inside = Window.partitionBy("canon", "slice").orderBy("at", "record_id", "full").rowsBetween(Window.unboundedPreceding, -1)
    near = usable.withColumn("near", F.last("state", ignorenulls=True).over(inside)).where("not full")
    ends = usable.where("full").groupBy("canon", "slice").agg(F.max_by("state", F.struct("at", "record_id")).alias("end"))
    asked = near.where("near is null").select("canon", "slice").distinct()
    span = F.floor(F.col("slice") / SPAN_SLICES).alias("span")
    inner = _before(ends.select("canon", span, "slice", "end"), asked.select("canon", span, "slice"), ["canon", "span"], "slice")
    last = ends.groupBy("canon", span).agg(F.max_by("end", "slice").alias("end"))
    outer = _before(last, inner.where("far is null").select("canon", "span").distinct(), ["canon"], "span")
    carried = inner.join(outer.withColumnRenamed("far", "further"), ["canon", "span"], "left").select("canon", "slice", F.coalesce("far", "further").alias("far"))
    joined = near.join(carried, ["canon", "slice"], "left").withColumn("src", F.coalesce("near", "far"))
    lost = kept.where(~whole & ~F.col("full")).withColumn("src", F.lit(None).cast(joined.schema["src"].dataType))
    cols = ["record_id", "canon", "at", "headers", "digest", "src"]
    return joined.select(*cols).unionByName(lost.select(*cols)).select(
        "record_id", "canon", "at", F.col("src.record_id").alias("source_id"), F.col("src.at").alias("source_at"), _status().alias("status"), _merged(_status()).alias("headers")
    )


def _status() -> Column:
    own, src = F.col("headers"), F.col("src.headers")
    pairs = ((F.col("digest"), F.col("src.digest")), (opaque_tag(own["etag"]), opaque_tag(src["etag"])), (own["last-modified"], src["last-modified"]))
    same = F.coalesce(*(F.when(a.isNotNull() & b.isNotNull(), a == b) for a, b in pairs))
    return F.when(F.col("src").isNull(), "missing").when(same.isNull(), "unchecked").when(same, "matched").otherwise("mismatch")


def _merged(status: Column) -> Column:
    fresh = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    stored = F.map_filter("src.headers", lambda k, _: ~F.array_contains(F.map_keys(fresh), k))
    return F.when(status.isin("matched", "unchecked"), F.map_concat(stored, fresh)).otherwise(F.col("headers"))


def captures(pages: DataFrame) -> DataFrame:
    """Captures derived from ``pages``: each page as a full response and, later or earlier, as a revisit under another spelling of its URL.

    Revisits name their page under another spelling: scheme, ``www.``, port, closing slash, order of parameters and fragment
    differ. Some lack validators or carry those of another version.
    """
    i, tag = F.col("page_id"), F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    body = F.md5("html")
    day = lambda x: F.concat(F.lit("day "), F.floor(x / 86400).cast("string"))
    url = F.col("url")
    host = F.translate(F.regexp_replace(host_of(url), r"^(www|m)\.|:(80|443)$", ""), LOWER, UPPER)
    query = F.array_join(F.reverse(F.split(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit("")), "&")), "&")
    spelled = F.concat(F.lit("HTTPS://WWW."), host, F.lit(":443"), path_of(url), F.lit("/?utm_source=again&"), query, F.lit("#again"))
    again = F.when(F.instr(url, "://") > 0, spelled).otherwise(F.concat(F.regexp_replace(url, "#.*$", ""), F.lit("#again")))
    response = pages.select(
        (2 * i).alias("record_id"), "url", (600 * i).alias("at"), F.lit("response").alias("kind"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.octet_length("html").cast("string"), F.lit("ETag"), tag, F.lit("Last-Modified"), day(600 * i), F.lit("Date"), (600 * i).cast("string")).alias("headers"),
        body.alias("digest"),
    )
    at = 600 * i + F.when(i % 17 == 0, -50).otherwise((i % 29) * 1000)
    sent = F.when(i % 11 == 0, F.lit('"other"')).when(i % 5 != 0, F.concat(F.lit("W/"), tag))
    revisit = pages.select(
        (2 * i + 1).alias("record_id"), again.alias("url"), at.alias("at"), F.lit("revisit").alias("kind"),
        F.create_map(F.lit("Date"), at.cast("string"), F.lit("Etag"), sent, F.lit("Last-Modified"), F.when(i % 7 != 0, day(600 * i)), F.lit("Cache-Control"), F.lit("max-age=60"), F.lit("Content-Length"), F.lit("0")).alias("headers"),
        F.when(i % 23 == 0, body).alias("digest"),
    )
    return response.unionByName(revisit)


def op5_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(captures(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws(": ", e["key"], e["value"])), "\n")
    return found.select("record_id", "canon", "at", "source_id", "source_at", "status", shown.alias("headers"))


_CANON = OP1_SQL.split("listed AS (")[0].split("canonical AS (")[1].rstrip().rstrip(",").rstrip(")")
OP5_SQL = rf"""
WITH captured AS (
  SELECT 2 * page_id AS record_id, url, 600 * page_id AS "at", true AS is_full, md5(html) AS digest, '"' || md5(html) || '"' AS etag,
    'day ' || CAST(floor(600 * page_id / 86400) AS BIGINT) AS modified, CAST(strlen(html) AS VARCHAR) AS size FROM pages
  UNION ALL BY NAME
  SELECT 2 * page_id + 1 AS record_id,
    CASE WHEN contains(url, '://') THEN concat('HTTPS://WWW.',
      translate(regexp_replace(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '^(www|m)\.|:(80|443)$', '', 'g'), '{LOWER}', '{UPPER}'),
      ':443', regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '/?utm_source=again&', array_to_string(list_reverse(string_split(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&')), '&'), '#again')
    ELSE regexp_replace(url, '#.*$', '') || '#again' END AS url,
    600 * page_id + CASE WHEN page_id % 17 = 0 THEN -50 ELSE (page_id % 29) * 1000 END AS "at", false AS is_full,
    CASE WHEN page_id % 23 = 0 THEN md5(html) END AS digest,
    CASE WHEN page_id % 11 = 0 THEN '"other"' WHEN page_id % 5 <> 0 THEN 'W/"' || md5(html) || '"' END AS etag,
    CASE WHEN page_id % 7 <> 0 THEN 'day ' || CAST(floor(600 * page_id / 86400) AS BIGINT) END AS modified, NULL AS size FROM pages),
parts AS (
  SELECT record_id AS page_id, url,
    translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1) AS query, '' AS content FROM captured),
canonical AS ({_CANON}),
records AS (SELECT c.*, k.canon FROM captured c JOIN canonical k ON k.page_id = c.record_id),
found AS (
  SELECT v.*, (SELECT max(struct_pack("at" := f."at", id := f.record_id)) FROM records f WHERE f.is_full AND f.canon = v.canon AND (f."at" < v."at" OR f."at" = v."at" AND f.record_id < v.record_id)) AS src
  FROM records v WHERE NOT v.is_full),
judged AS (
  SELECT v.*, f."at" AS f_at, f.record_id AS f_id, f.etag AS f_etag, f.modified AS f_modified, f.size AS f_size,
    CASE WHEN f.record_id IS NULL THEN 'missing'
      WHEN v.digest IS NOT NULL AND f.digest IS NOT NULL THEN CASE WHEN v.digest = f.digest THEN 'matched' ELSE 'mismatch' END
      WHEN v.etag IS NOT NULL THEN CASE WHEN regexp_replace(v.etag, '^W/', '') = f.etag THEN 'matched' ELSE 'mismatch' END
      WHEN v.modified IS NOT NULL THEN CASE WHEN v.modified = f.modified THEN 'matched' ELSE 'mismatch' END
      ELSE 'unchecked' END AS status
  FROM found v LEFT JOIN records f ON f.record_id = v.src.id AND f.is_full)
SELECT record_id, canon, "at", f_id AS source_id, f_at AS source_at, status,
  CASE WHEN status IN ('matched', 'unchecked')
    THEN concat_ws(chr(10), 'cache-control: max-age=60', 'content-length: ' || f_size, 'content-type: text/html', 'date: ' || "at", 'etag: ' || coalesce(etag, f_etag), 'last-modified: ' || coalesce(modified, f_modified))
    ELSE concat_ws(chr(10), 'cache-control: max-age=60', 'content-length: 0', 'date: ' || "at", 'etag: ' || etag, 'last-modified: ' || modified) END AS headers
FROM judged
"""

QUERIES = {"op5_revisits": op5_revisits}
SQL = {"op5_revisits": OP5_SQL}
