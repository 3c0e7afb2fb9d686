"""URL filters: a blocked Bloom filter in front of an exact hash join.

A list of canonical URLs may be as long as the corpus. It is folded into a blocked Bloom filter, a small table
of 512-bit blocks: a URL's first hash picks one block, its second sets one bit in each of the block's eight words.
The filter's size has a fixed bound, so it can be broadcast whatever the length of the list: a longer list only
fills the blocks and lets more false positives through. Pages that miss the filter are decided on the spot, without
a shuffle; possible hits go to an exact join with the list, which removes the false positives.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaria.llm.common import ascii_lower, stage, table

#: URLs that a block of 512 bits takes before the filter grows by another block.
KEYS_PER_BLOCK = 64
#: Bound of the broadcast filter, in bytes of blocks.
FILTER_BYTES = 16 << 20
WORDS = 8

#: (host, path, verdict) of the production rules.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

#: First hex digits of the MD5 of the contents that are on the list of the production query.
LISTED_CONTENTS = ("0", "1", "2", "3")


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """One spelling of the URLs that name the same page; null without ``://``.

    Drops scheme, ``www.`` or ``m.``, the default ports, the fragment, closing slashes and the parameters ``ref`` and
    ``utm_*``; sorts the other parameters.
    """
    host = F.regexp_replace(host_of(url), r"^(www|m)\.|:(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(ref|utm_[^=]*)(=|$)")))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, tail))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], what: int | None = None) -> Column:
    """The longest rule that fits, as ``host + path``, or its verdict with ``what=2``; null if none fits.

    A rule fits its host and all subdomains if the path starts with the rule's. Of equally long rules the first in
    byte order wins. Rules are a short literal list; long lists belong into ``listed`` of :func:`filter_urls`.
    """
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r[0] + r[1]), [-b for b in (r[0] + r[1]).encode()])):
        fits = ((host == r[0]) | host.endswith("." + r[0])) & path.startswith(r[1])
        found = F.when(fits, F.lit(r[0] + r[1] if what is None else r[what])).otherwise(found)
    return found


def _block(canon: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(canon), F.lit(blocks).cast("long"))


def _mask(canon: Column, word: int) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (F.shiftrightunsigned(F.xxhash64(canon, F.lit(1)), 6 * word).bitwiseAND(F.lit(63))).cast("int"))


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter: ``block`` and its words ``w0`` to ``w7``, for the blocks that are not empty. ``listed``: one column, ``canon``."""
    canon = F.col("canon")
    return listed.groupBy(_block(canon, blocks).alias("block")).agg(*(F.bit_or(_mask(canon, i)).alias(f"w{i}") for i in range(WORDS)))


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, url: str = "url", filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Judges every row of ``pages``: the longest fitting rule, else ``block`` if the URL is listed, else ``allow``.

    ``listed`` has a string column ``canon`` of canonical URLs; nulls and repeats in it count for nothing.
    Adds ``host``, ``path``, ``canon``, ``rule``, ``possible`` (passed the Bloom filter) and ``verdict``; columns of
    these names in the input are replaced, all others stay. A null URL or one without ``://`` has an empty host and
    path and is allowed. Empty tables give empty results; an empty list blocks nothing.
    A list entry that many pages share is a skewed join key: both sides are plain scans below the join, so that
    adaptive execution can split it.
    """
    made = ("host", "path", "canon", "rule", "possible", "verdict")
    url_col = F.col(url)
    host, path = host_of(url_col), path_of(url_col)
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in made]
    entries = stage(listed.select(F.col("canon").cast("string")).where("canon is not null").distinct(), "url-list")
    blocks = max(1, min(math.ceil(entries.count() / KEYS_PER_BLOCK), filter_bytes // (8 * WORDS)))
    bloom = F.broadcast(stage(bloom_blocks(entries, blocks), "url-bloom").select(F.col("block").alias("__block"), *(F.col(f"w{i}").alias(f"__w{i}") for i in range(WORDS))))

    base = pages.select(*kept, host.alias("host"), path.alias("path"), canonical_url(url_col).alias("canon"), rule_of(host, path, rules).alias("rule"), rule_of(host, path, rules, 2).alias("__said"))
    base = base.withColumn("__block", _block(F.col("canon"), blocks))
    in_filter = F.lit(True)
    for i in range(WORDS):
        mask = _mask(F.col("canon"), i)
        in_filter = in_filter & (F.col(f"__w{i}").bitwiseAND(mask) == mask)
    seen = base.join(bloom, "__block", "left").withColumn("possible", F.coalesce(in_filter & F.col("rule").isNull() & F.col("canon").isNotNull(), F.lit(False)))
    hit = entries.select(F.col("canon").alias("__entry"), F.lit(True).alias("__hit"))
    sure = seen.where(~F.col("possible")).withColumn("__hit", F.lit(False))
    checked = seen.where("possible").join(hit, F.col("canon") == F.col("__entry"), "left").drop("__entry")
    verdict = F.coalesce(F.col("__said"), F.when(F.coalesce("__hit", F.lit(False)), "block").otherwise("allow"))
    return sure.unionByName(checked).select(*kept, "host", "path", "canon", "rule", "possible", verdict.alias("verdict"))


def listed_pages(pages: DataFrame) -> DataFrame:
    """The production list, as it might be handed in from elsewhere: URLs of reported contents, one in four of all, each under another spelling.

    Hosts are mixed, so only the URL itself tells whether a page is listed.
    """
    url, report = F.col("url"), F.substring(F.md5("html"), 1, 1)
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    spelled = F.concat(F.lit("HTTPS://WWW."), F.upper(host_of(url)), F.lit(":443"), path_of(url), query, F.when(query != "", "&").otherwise("?"), F.lit("utm_source=report#seen"))
    bare = F.regexp_replace(spelled, r"^(HTTPS://WWW\.)(?i:www\.|m\.)", "$1")
    bare = F.regexp_replace(bare, r":(80|443):443", ":443")
    return pages.where(report.isin(*LISTED_CONTENTS) & (F.instr(url, "://") > 0)).select(canonical_url(bare).alias("canon"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return filter_urls(pages, listed_pages(pages)).select("page_id", "host", "path", "rule", "verdict", "canon")


OP1_SQL = r"""
WITH parts AS (
  SELECT page_id, url,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '') AS query, md5(html)[1] AS content
  FROM pages),
canonical AS (
  SELECT page_id, host, path, content,
    list_sort(list_filter(string_split(query, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(ref|utm_[^=]*)(=|$)'))) AS kept,
    CASE WHEN contains(url, '://') THEN concat(regexp_replace(host, '^(www|m)\.|:(80|443)$', '', 'g'), regexp_replace(path, '/+$', ''),
      CASE WHEN len(kept) > 0 THEN concat('?', array_to_string(kept, '&')) ELSE '' END) END AS canon
  FROM parts),
listed AS (
  SELECT DISTINCT canon FROM canonical WHERE canon IS NOT NULL AND content IN ('0', '1', '2', '3')),
rules(r_host, r_path, said) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (
  SELECT c.page_id, arg_max(concat(r_host, r_path), length(concat(r_host, r_path))) AS rule, arg_max(said, length(concat(r_host, r_path))) AS said
  FROM canonical c JOIN rules r ON (c.host = r_host OR ends_with(c.host, '.' || r_host)) AND starts_with(c.path, r_path)
  GROUP BY c.page_id)
SELECT c.page_id, c.host, c.path, f.rule, coalesce(f.said, CASE WHEN l.canon IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, c.canon
FROM canonical c LEFT JOIN fits f USING (page_id) LEFT JOIN listed l ON l.canon = c.canon
"""

QUERIES = {"op1_url_filter": op1_url_filter}
SQL = {"op1_url_filter": OP1_SQL}
