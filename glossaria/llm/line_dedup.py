"""Line dedup by distinct-site spread.

How many sites a line stands on is counted by a HyperLogLog sketch per line hash; sketches of the tasks merge in the
aggregation, so a line that stands in a third of all documents costs one small sketch a task. Lines whose estimate is
so near the threshold that the sketch may err get an exact distinct count. Lines that reach the threshold are
boilerplate and leave all documents but the first. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaria.llm.common import stage, table

#: Sites from which on a line is boilerplate.
MIN_SITES = 10
#: Shorter lines are left alone: a few short words meet by chance.
MIN_WORDS = 3
#: Base-2 logarithm of the sketch's registers, and the standard errors round the threshold that are counted exactly.
LG_REGISTERS, ERRORS = 10, 5
#: A list of boilerplate lines up to this many rows (32 bytes each) is broadcast; beyond, the join shuffles.
BROADCAST_LINES = 200_000

_SPACE, _WORD = r"[ \t-\r]", r"[^ \t-\r]"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _judged(line: Column, min_words: int) -> Column:
    return line.rlike(f"({_WORD}+{_SPACE}+){{{min_words - 1}}}{_WORD}") if min_words > 1 else line.rlike(_WORD)


def _occurrences(docs: DataFrame, site: str, min_words: int) -> DataFrame:
    lines = docs.select(F.col("doc_id").alias("id"), F.col(site).alias("site"), F.explode(_lines(F.coalesce("text", F.lit("")))).alias("line"))
    return lines.where(_judged(F.col("line"), min_words)).select("id", "site", _key(F.col("line")).alias("key"))


def _checked(small: DataFrame, most: int) -> DataFrame:
    """``small``, a staged table, to be broadcast if it has no more than ``most`` rows."""
    return F.broadcast(small) if small.count() <= most else small


def boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """``key`` (MD5 of the line) and ``first`` (smallest doc_id that has it) of every line on ``min_sites`` sites or more. Null sites don't count.

    A sketch keeps few sites exactly. Where there are more, its estimate may be wrong by over ``ERRORS`` standard errors
    once in some million lines, and only lines nearer to the threshold than that are counted again: up to a threshold of
    some hundred sites the result is exact, beyond it all but.
    """
    margin = math.ceil(ERRORS * 1.04 / math.sqrt(1 << LG_REGISTERS) * min_sites)
    found = _occurrences(docs, site, min_words)
    sketched = found.groupBy("key").agg(F.hll_sketch_agg("site", F.lit(LG_REGISTERS)).alias("sketch"), F.min("id").alias("first"))
    spread = sketched.select("key", F.hll_sketch_estimate("sketch").alias("sites"), "first").where(F.col("sites") >= min_sites - margin)
    spread = stage(spread, "line-spread")
    near = _checked(spread.where(F.col("sites") <= min_sites + margin).select("key"), BROADCAST_LINES)
    exact = found.select("key", "site").join(near, "key", "left_semi").distinct().groupBy("key").agg(F.count("site").alias("sites")).where(F.col("sites") >= min_sites)
    sure = spread.where(F.col("sites") > min_sites + margin).select("key", "first")
    return stage(sure.union(spread.join(exact.select("key"), "key", "left_semi").select("key", "first")), "line-boilerplate")


def remove_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and ``n_removed``, the lines taken out.

    The document with the smallest id keeps its copy of a line, so that a document copied to many sites survives
    once. Lines are parted by ``\\n`` only, count whole and exactly, and the rest of a text stays as it was; a null
    text stays null. A null id is never the smallest unless all are null; rows that share an id are treated alike.
    Empty tables give empty results. An input column ``n_removed`` is replaced, all others stay.
    """
    lines = boilerplate(docs, site, min_sites, min_words)
    hits = _occurrences(docs, site, min_words).join(_checked(lines, BROADCAST_LINES), "key").where(~F.col("id").eqNullSafe(F.col("first")) & F.col("first").isNotNull())
    drop = hits.groupBy(F.col("id").alias("__id")).agg(F.collect_set("key").alias("__drop"))
    joined = docs.drop("n_removed").join(drop, F.col("doc_id").eqNullSafe(F.col("__id")), "left")
    kept = F.filter(_lines(F.col("text")), lambda x: ~F.array_contains("__drop", _key(x)))
    joined = joined.withColumn("__kept", F.when(F.col("__drop").isNotNull() & F.col("text").isNotNull(), kept))
    n = F.when(F.col("__kept").isNotNull(), F.size(_lines(F.col("text"))) - F.size("__kept")).otherwise(0)
    rest = [F.coalesce(F.array_join("__kept", "\n"), F.col("text")).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns if c != "n_removed"]
    return joined.select(*rest, n.cast("long").alias("n_removed"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return cleaned.select("doc_id", "source", "n_removed", F.length("text").cast("long").alias("chars_left"), F.md5("text").alias("text_md5"))


OP6_SQL = rf"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL),
boilerplate AS (
  SELECT line, min(doc_id) AS first FROM lines
  WHERE regexp_matches(line, '([^ \t-\r]+[ \t-\r]+){{{MIN_WORDS - 1}}}[^ \t-\r]')
  GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}),
dropped AS (
  SELECT doc_id, list(DISTINCT line) AS gone FROM lines JOIN boilerplate USING (line) WHERE doc_id IS DISTINCT FROM first GROUP BY doc_id),
cleaned AS (
  SELECT d.doc_id, d.source, string_split(d.text, chr(10)) AS before,
    CASE WHEN g.gone IS NULL THEN string_split(d.text, chr(10)) ELSE list_filter(string_split(d.text, chr(10)), lambda x: NOT list_contains(g.gone, x)) END AS after
  FROM documents d LEFT JOIN dropped g USING (doc_id))
SELECT doc_id, source, CAST(len(before) - len(after) AS BIGINT) AS n_removed,
  CAST(length(coalesce(array_to_string(after, chr(10)), '')) AS BIGINT) AS chars_left, md5(coalesce(array_to_string(after, chr(10)), '')) AS text_md5
FROM cleaned
"""

QUERIES = {"op6_line_dedup": op6_line_dedup}
SQL = {"op6_line_dedup": OP6_SQL}
