"""SimHash near-duplicates with pigeonring filtering.

Fingerprints within ``RADIUS`` bits are links, and documents joined by links are one group. The 64 bits are five
segments on a ring. If two fingerprints differ in at most 4 bits, then from some segment on the differences of each
run of 1, 2, ... 5 consecutive segments stay within the run's share of the budget: 0, 1, 2, 3, 4 bits. The first two
shares make the join key (a segment equal, the next within one bit: 26 bits); the third and fourth prune what meets
there before all 64 bits are compared.

Copies fall together before any join, as only distinct fingerprints take part. Large groups of near copies are first
drawn together through fingerprints that differ in one half-byte only, which takes a row for each of the 16; the
search then looks for links between what is still apart, and the largest group of a join key is not compared with itself.
So a group's pairs are never all listed, and no link between groups is lost.

A key of 26 bits is for some hundred million different fingerprints: N of them meet by chance about N * N / 2**20 times
in all. Beyond, each further bit of a key (longer segments, and so fewer of them for one more neighbour) halves that.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossaria.llm.common import bound_batches, id_and_text, shuffle_partitions, stage, table
from glossaria.llm.components import connected_components

WIDTH = 4
SEED = 42
RADIUS = 4
#: First bit (from the lowest) and bits of each segment of the ring.
SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Documents to leave out are broadcast up to this many (8 bytes each); beyond, the join shuffles.
BROADCAST_IDS = 500_000
_BLOCK = 1 << 15


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The signed 64-bit SimHash of a text's shingles of ``width`` words.

    A-Z are lower-cased, words end at ASCII white space. A text of fewer words is one shingle, one without words has 0.
    A bit is set if it is set in over half of the shingles' XXH64, repeats included.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    ends = ends.tolist()
    starts = [0, *(e + 1 for e in ends[:-1])]
    spans = list(zip(starts, ends[width - 1 :], strict=False)) or [(0, len(joined))]
    ones = np.zeros(64, np.int64)
    of = xxhash.xxh64_intdigest
    for at in range(0, len(spans), _BLOCK):
        hashes = np.array([of(joined[s:e], SEED) for s, e in spans[at : at + _BLOCK]], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(spans)).view(">i8")[0])


def simhash(text: Column, width: int = WIDTH) -> Column:
    """:func:`fingerprint` of a text column, as long."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width) for t in texts], dtype="int64")

    return run(text)


def _mask(first: int, bits: int) -> int:
    """The bits of a run of segments, as a signed long; runs past the highest bit go on at the lowest."""
    m = sum(1 << ((first + k) % 64) for k in range(bits))
    return m - (1 << 64) if m >> 63 else m


def _run(i: int, n: int) -> int:
    return _mask(SEGMENTS[i][0], sum(SEGMENTS[(i + k) % 5][1] for k in range(n)))


def _segment(fp: Column, i: int) -> Column:
    first, bits = SEGMENTS[i]
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def _rows(fps: DataFrame) -> DataFrame:
    """Each fingerprint under its join keys: number of the segment, the segment, the next one, as it is (``own``) or with one bit changed."""
    keys = []
    for i in range(5):
        j, bits = (i + 1) % 5, SEGMENTS[(i + 1) % 5][1]
        here = F.lit(i << 26).bitwiseOR(F.shiftleft(_segment(F.col("fp"), i), 13))
        then = _segment(F.col("fp"), j)
        keys += [F.struct(here.bitwiseOR(then).alias("key"), F.lit(True).alias("own"))]
        keys += [F.struct(here.bitwiseOR(then.bitwiseXOR(F.lit(1 << b))).alias("key"), F.lit(False).alias("own")) for b in range(bits)]
    return fps.select("*", F.explode(F.array(*keys)).alias("k")).select(*fps.columns, "k.key", "k.own")


def _within_half_byte(fps: DataFrame) -> DataFrame:
    """Edges between fingerprints that differ inside one half-byte, at most ``RADIUS`` bits; at most 16 share a row's key."""
    masks = F.array(*(F.struct(F.lit(k).alias("at"), F.col("fp").bitwiseAND(F.lit(~_mask(4 * k, 4))).alias("rest")) for k in range(16)))
    keyed = fps.select("fp", F.explode(masks).alias("k"))
    least = keyed.withColumn("least", F.min("fp").over(Window.partitionBy("k.at", "k.rest")))
    return least.where("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b"))


def _close(x: Column, y: Column, key: Column) -> Column:
    """Whether the chain from the key's segment stays within its shares, and all bits within ``RADIUS``."""
    diff, i = x.bitwiseXOR(y), F.shiftrightunsigned(key, 26)
    chain = F.lit(True)
    for n in (3, 4):
        mask = F.lit(_run(4, n))
        for k in range(3, -1, -1):
            mask = F.when(i == k, F.lit(_run(k, n))).otherwise(mask)
        chain = chain & (F.bit_count(diff.bitwiseAND(mask)) <= RADIUS * n // 5)
    return chain & (F.bit_count(diff) <= RADIUS)


def link_groups(fps: DataFrame) -> DataFrame:
    """``fp`` and ``root`` for the fingerprints of ``fps`` (distinct, column ``fp``) that have a link; the root is the group's smallest fingerprint."""
    near = stage(connected_components(_within_half_byte(fps)), "near")
    sized = near.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    drawn = near.join(sized, "root").select(F.col("node").alias("fp"), F.col("root").alias("part"), "size")
    placed = fps.join(drawn, "fp", "left").select("fp", F.coalesce("part", "fp").alias("part"), F.coalesce("size", F.lit(1)).alias("size"))
    parts = stage(placed.repartition(shuffle_partitions(fps.sparkSession), "fp"), "parts")  # many tasks open the keys

    # One shuffle of all keys; a window spills where many fingerprints share one, and the joins below are of plain scans.
    per = Window.partitionBy("key")
    met = _rows(parts).select(
        "key", "fp", "part", "own", F.min("part").over(per).alias("low"), F.max("part").over(per).alias("high"),
        F.max("own").over(per).alias("any"), F.max(F.struct("size", "part")).over(per)["part"].alias("main"),
    )
    met = stage(met.where("low <> high and any").select("key", "fp", "part", "own", (F.col("part") == F.col("main")).alias("main")), "met")
    right = met.select(F.col("key").alias("key2"), F.col("fp").alias("fp2"), F.col("part").alias("part2"), F.col("main").alias("main2"))
    apart = (F.col("key") == F.col("key2")) & (F.col("part") != F.col("part2")) & _close(F.col("fp"), F.col("fp2"), F.col("key"))
    few = met.where("own and not main").join(right, apart)
    many = met.where("own and main").join(right.where("not main2"), apart)
    links = few.select("part", "part2").unionByName(many.select("part", "part2")).distinct()
    merged = stage(connected_components(links), "merged")
    joined = parts.join(merged.withColumnRenamed("node", "part"), "part", "left").select("fp", F.coalesce("root", "part").alias("root"), (F.col("root").isNotNull() | (F.col("size") > 1)).alias("linked"))
    return joined.where("linked").select("fp", "root")


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """A row per document: ``doc_id``, ``fp`` (long), ``component_id``: the smallest doc_id that links reach, its own included.

    Null texts count as empty, and empty texts link to each other like any others. A null id is never the smallest
    and the component of documents without any id is null. Rows that share an id are judged each by their text.
    An empty table gives an empty result; columns but ``doc_id`` and ``text`` are not read.
    """
    marked = stage(id_and_text(docs).select("doc_id", simhash(F.col("text"), width).alias("fp")), "fingerprints")
    first = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "first")
    groups = stage(link_groups(first.select("fp")), "groups")
    smallest = groups.join(first, "fp").groupBy("root").agg(F.min("first").alias("component_id"))
    linked = groups.join(smallest, "root").select("fp", "component_id")
    all_of = stage(first.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id")), "components")
    return marked.join(all_of, "fp").select("doc_id", "fp", "component_id")  # both are plain scans, so a hot fingerprint can be split


def drop_near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id; rows without an id stay.

    Rows that share an id are one document and stay or go together.
    """
    found = near_duplicates(docs, width)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("__id")).distinct()
    gone = stage(gone, "copies")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(gone, docs["doc_id"] == gone["__id"], "left_anti")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op9_simhash": op9_simhash}
SQL: dict[str, str] = {}
