"""Sharding by extendible hashing.

A document's key hashes to a string of bits. A bucket is a prefix of bits; a bucket over the byte limit splits on its
next bit, the others stay as they are. The directory maps every prefix of the deepest level in use to its bucket.
Splits are decided on sums per prefix, not on rows, and only rows of buckets that are still too large are looked at
again with more bits. DataFrame functions only.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossaria.llm.common import stage, table

#: Bytes of text that a shard takes.
LIMIT_BYTES = 4 << 20
#: Levels that each round adds; a round's histogram has at most this many levels more than its buckets need.
SPARE_LEVELS, DEEPER = 4, 12
#: Levels whose sums are made from one another's cells at once.
STEP_LEVELS = 12
#: Bits of the key's hash (MD5), then of the content's (two 64-bit hashes).
KEY_BITS, ALL_BITS = 128, 256
#: A directory up to this many entries (about 50 bytes each) is broadcast; a larger one is joined by a shuffle.
BROADCAST_ENTRIES = 100_000
#: Equal rows that a task ranks.
RANKED_TOGETHER = 50_000


def _hash(doc_id: Column, text: Column) -> Column:
    """64 hex digits: the key's hash, then the content's, so that rows of one key can still be told apart."""
    content = F.concat(F.lpad(F.hex(F.xxhash64(text)), 16, "0"), F.lpad(F.hex(F.xxhash64(text, F.lit(1))), 16, "0"))
    return F.concat(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lower(content))


def _bits(digest: Column, depth: int) -> Column:
    """The first ``depth`` bits as a string of 0 and 1."""
    chunks = [F.lpad(F.conv(F.substring(digest, at, 8), 16, 2), 32, "0") for at in range(1, math.ceil(depth / 4) + 1, 8)]
    return F.substring(F.concat(*chunks), 1, depth) if depth else F.lit("")


def _split(cells: DataFrame, depth_from: int, depth_to: int, limit: int) -> DataFrame:
    """The directory: ``cell`` (``depth_to`` bits) and ``shard``, the shortest prefix of ``depth_from`` bits or more that fits or holds one row; null where even the cell is too large."""
    levels = cells.select("cell", "bytes", "rows", F.explode(F.sequence(F.lit(depth_from), F.lit(depth_to))).alias("depth")).withColumn("prefix", F.expr("substring(cell, 1, depth)"))
    sums = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("held"), F.sum("rows").alias("n")).where((F.col("held") <= limit) | (F.col("n") == 1))
    fits = levels.select("cell", "depth", "prefix").join(sums, ["depth", "prefix"], "left")
    return fits.groupBy("cell").agg(F.min(F.when(F.col("held").isNotNull(), F.col("depth"))).alias("d")).select("cell", F.expr("substring(cell, 1, d)").alias("shard"))


def _directory(cells: DataFrame, depth_from: int, depth_to: int, limit: int, step: int = STEP_LEVELS) -> DataFrame:
    """:func:`_split` over many levels, ``step`` of them at a time: only cells below prefixes that are too large are looked at again."""
    if depth_to - depth_from <= step:
        return _split(cells, depth_from, depth_to, limit)
    placed = []
    while True:
        till = min(depth_to, depth_from + step)
        prefix = F.expr(f"substring(cell, 1, {till})")
        coarse = cells.groupBy(prefix.alias("cell")).agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        found = stage(_split(coarse, depth_from, till, limit).withColumnRenamed("cell", "__at"), "shard-levels")
        held = cells.join(found, prefix == F.col("__at"))
        if till == depth_to:
            placed.append(held.select("cell", "shard"))
            return reduce(DataFrame.union, placed)
        placed.append(held.where("shard is not null").select("cell", "shard"))
        cells = stage(held.where("shard is null").select("cell", "bytes", "rows"), "shard-cells")
        depth_from = till


def assign_shards(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """A row per document: ``doc_id``, ``bytes`` (UTF-8 length of ``text``), ``shard``, ``overflow``.

    ``shard`` is the bucket's bits. No shard holds more than ``limit`` bytes, except one that is a single longer document.
    Rows of one key split on the hash of their content; equal rows that alone exceed the limit get overflow
    chunks, ``overflow`` numbering them (else 0) and the shard being named by its hash, the rows' size and the number.
    A null text has no bytes, null ids are one key, an empty table gives an empty result; other columns are not read.
    """
    return _assign(docs, limit)


def _assign(docs: DataFrame, limit: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """:func:`assign_shards`; ``carry`` names the column that numbers the rows, to be handed on, or is empty."""
    text = F.coalesce("text", F.lit(""))
    rows = stage(docs.select("doc_id", F.octet_length(text).cast("long").alias("bytes"), _hash(F.col("doc_id"), text).alias("digest"), *carry), "shard-rows")
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    low, high = 0, min(ALL_BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + SPARE_LEVELS)
    pending, done = rows, []
    while True:
        at = _bits(F.col("digest"), high)
        cells = pending.groupBy(at.alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        directory = stage(_directory(cells, low, high, limit), "shard-directory")
        known = directory.where("shard is not null")
        entries, oversized = directory.count(), directory.where("shard is null").count()
        held = pending.withColumn("cell", at).join(F.broadcast(directory) if entries <= BROADCAST_ENTRIES else directory, "cell", "left")
        done.append(held.where("shard is not null").select("doc_id", "bytes", "shard", F.lit(0).cast("long").alias("overflow"), *carry))
        if not oversized:
            break
        pending = stage(held.where("shard is null").select("doc_id", "bytes", "digest", *carry), "shard-pending")
        if high == ALL_BITS:
            done.append(_overflow_rows(pending, limit, *carry) if carry else _overflow(pending, limit))
            break
        low, high = high, min(ALL_BITS, high + DEEPER)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _overflow(pending: DataFrame, limit: int) -> DataFrame:
    """Chunks of rows that no bit tells apart: counted first, then dealt out by number."""
    alike = pending.groupBy("doc_id", "digest", "bytes").agg(F.count(F.lit(1)).alias("copies"))
    each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("bytes", F.lit(1)))).cast("long")
    chunks = alike.withColumn("each", each).withColumn("overflow", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("copies") / F.col("each")))))
    here = F.least("each", F.col("copies") - (F.col("overflow") - 1) * F.col("each"))
    shard = F.concat_ws("-", "digest", F.col("bytes").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("overflow").cast("string"))
    return chunks.withColumn("shard", shard).select("doc_id", "bytes", "shard", "overflow", F.explode(F.sequence(F.lit(1).cast("long"), here)).alias("__copy")).drop("__copy")


def _overflow_rows(pending: DataFrame, limit: int, row: str) -> DataFrame:
    """The chunks of :func:`_overflow` for rows numbered by ``row``: ranked in groups of bounded size, however many are equal."""
    groups = max(1, -(-pending.count() // RANKED_TOGETHER))
    key = ["digest", "bytes"]
    dealt = pending.withColumn("__group", F.pmod(F.xxhash64(row), F.lit(groups)))
    sizes = dealt.groupBy(*key, "__group").agg(F.count(F.lit(1)).alias("__size"))
    before = F.coalesce(F.sum("__size").over(Window.partitionBy(*key).orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rank = F.row_number().over(Window.partitionBy(*key, "__group").orderBy(row)) - 1 + F.col("__before")
    ranked = dealt.join(sizes.withColumn("__before", before).drop("__size"), [*key, "__group"]).withColumn("__rank", rank)
    each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("bytes", F.lit(1)))).cast("long")
    numbered = ranked.withColumn("overflow", (F.floor(F.col("__rank") / each) + 1).cast("long"))
    shard = F.concat_ws("-", "digest", F.col("bytes").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("overflow").cast("string"))
    return numbered.select("doc_id", "bytes", shard.alias("shard"), "overflow", row)


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT_BYTES) -> None:
    """Writes ``docs`` as Parquet with a folder per shard, each row once; ids may repeat or be null. ``shard`` in the input is replaced.

    A folder's name is the shard's with a ``b`` in front, so that a plain reader takes it for text, leading zeros and all.
    """
    held = stage(docs.drop("shard").withColumn("__row", F.monotonically_increasing_id()), "shard-input")
    placed = held.join(_assign(held, limit, ("__row",)).select("__row", "shard"), "__row").drop("__row").withColumn("shard", F.concat(F.lit("b"), "shard"))
    placed.repartition("shard").write.partitionBy("shard").parquet(path)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP4_SQL = f"""
WITH RECURSIVE keyed AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS bytes, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
spelled AS (
  SELECT doc_id, bytes, array_to_string(list_transform(string_split(digest[1:10], ''), lambda x: right('000' || bin(CAST('0x' || x AS INTEGER)), 4)), '') AS bits FROM keyed),
buckets AS (
  SELECT 0 AS depth, '' AS prefix, CAST(sum(bytes) AS BIGINT) AS held, count(*) AS n FROM spelled
  UNION ALL
  SELECT b.depth + 1 AS depth, s.bits[1:b.depth + 1] AS prefix, CAST(sum(s.bytes) AS BIGINT) AS held, count(*) AS n
  FROM buckets b JOIN spelled s ON s.bits[1:b.depth] = b.prefix WHERE b.held > {LIMIT_BYTES} AND b.n > 1 AND b.depth < 40
  GROUP BY b.depth, b.prefix, s.bits[1:b.depth + 1]),
leaves AS (SELECT depth, prefix FROM buckets WHERE held <= {LIMIT_BYTES} OR n = 1)
SELECT s.doc_id, s.bytes, l.prefix AS shard, CAST(0 AS BIGINT) AS overflow
FROM spelled s JOIN leaves l ON s.bits[1:l.depth] = l.prefix
"""

QUERIES = {"op4_sharding": op4_sharding}
SQL = {"op4_sharding": OP4_SQL}
