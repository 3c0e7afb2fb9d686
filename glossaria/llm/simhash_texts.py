"""SimHash near duplicates of texts at a Jaccard similarity of five-word shingles.

At a similarity of 0.8 the bits of a SimHash differ in 15 of 100 places, too many for keys that miss no such pair. So
the bit sums of a text's shingles are rounded more coarsely than to their signs: they are turned ``DIGITS`` times, and
each time the place and the sign of the largest of ``SIDES`` sums is one digit. Digits of similar texts are equal some
two times in five or more, those of others one time in ``2 * SIDES``.

Fingerprints are rings of digits, each a segment. If two of them differ in at most ``RADIUS`` digits, then from some
digit on the differences among each run of 1, 2, ... digits stay within the run's share of the radius: none in the
first, one in the first three, five in the first eight. The first two shares make the join key (a digit and one of the
next two are equal); the third prunes what meets there, then the whole rings are compared. Within the radius no pair is
missed. Farther ones meet by the same keys more often than not, so those up to ``FAR`` differing digits are let through
as well. All are judged by their whole sets of shingles, so no link is made up, but some pairs just above the similarity
don't meet. ``exact`` finds these too, by a prefix filter: of a text's shingles, ordered by hash, one of the first fifth
and one more is among those of every text that is similar enough. It has a key for each of them, of two parts only.

Copies fall together first, by a 64-bit hash of their words; where two different texts share it, which a second one tells,
the second takes its place. Then the texts of a key are compared with the one whose
keys are the most shared, which draws large groups together; after that only texts of different parts are compared,
and the largest part of a key not with itself. Joins compare rings and sketches at once, so that of texts which are only
somewhat alike no pair leaves them. A text has ``GAPS * DIGITS`` keys and meets by chance ``GAPS * DIGITS / (2 * SIDES)
** 2`` of all other texts, so the parameter ``sides`` should grow with the square root of their number (:func:`sides_for`):
2,048 suits some 50 million different texts, 16,384 some billions. More sides make equal digits rarer, so that without
``exact`` more pairs of a similarity just above 0.8 are missed.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from operator import or_

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossaria.llm.common import ascii_lower, id_and_text, shuffle_partitions, stage
from glossaria.llm.components import connected_components
from glossaria.llm.simhash import BROADCAST_IDS

WIDTH = 5
SEED = 42
#: Similarity from which texts are linked, as a fraction.
OVER, UNDER = 4, 5
#: Digits of a fingerprint, sums that each is the largest of (a power of two, and the most that a digit of 16 bits can tell), digits that may differ.
DIGITS, SIDES, MOST_SIDES, RADIUS = 32, 2048, 16384, 21
#: Different texts that ``SIDES`` suits.
SUITED = 50_000_000
#: Bits that are summed up, each of them part of every side with a sign of its own.
SUMS = 512
#: The shares of the radius let one of the first ``GAPS + 1`` digits differ and five of the first ``WINDOW``.
GAPS, WINDOW = 2, 8
#: Differing digits up to which pairs that meet are looked at.
FAR = 26
#: Bits of each digit that a window holds, six of them in a long.
WINDOW_BITS = 10
#: Longs of a sketch of parities.
SKETCH = 8
#: Texts turned at once, and shingles whose sums are added at once.
TOGETHER, BLOCK = 8, 8192

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) * 2.0 - 1
_STREAMS = np.array([(0x9E3779B97F4A7C15 * (2 * k + 1)) % (1 << 64) | 1 for k in range(SUMS // 64)], np.uint64)


@lru_cache
def _signs(sides: int) -> np.ndarray:
    return np.where(np.random.RandomState(SEED).randint(0, 2, (sides, DIGITS)), 1, -1).astype(np.int16)


def sides_for(texts: int) -> int:
    """``sides`` for so many different texts: each meets no more of the others by chance than at ``SUITED`` texts, as far as digits can tell."""
    sides = SIDES
    while sides < MOST_SIDES and texts * SIDES**2 > SUITED * sides**2:
        sides *= 2
    return sides


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The sorted hashes of a text's different shingles, signed 64 bits.

    A-Z are lower-cased, words end at ASCII white space. A text of fewer words, or of none, is one shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    joined, of = b" ".join(words), xxhash.xxh64_intdigest
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist() if words else []
    spans = list(zip([0, *(e + 1 for e in ends[:-1])], ends[width - 1 :], strict=False)) or [(0, len(joined))]
    found = np.fromiter((of(joined[s:e], SEED) for s, e in spans), np.uint64, len(spans))
    return np.unique(found.view(np.int64))


def bit_sums(found: np.ndarray) -> np.ndarray:
    """For each of ``SUMS`` bits of the shingles' hashes how many more have it set than not."""
    places = np.arange(SUMS // 8) << 8
    counts = np.zeros(SUMS // 8 << 8, np.int64)
    for at in range(0, len(found), BLOCK):
        mixed = found[at : at + BLOCK].view(np.uint64)[:, None] * _STREAMS
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ mixed >> np.uint64(32)).astype("<u8").view(np.uint8)
        counts += np.bincount((mixed + places).ravel(), minlength=len(counts))
    return (counts.reshape(-1, 256) @ _BITS).ravel().astype(np.int64)  # whole numbers, exact as floats


def digits(sums: np.ndarray, sides: int = SIDES) -> np.ndarray:
    """``DIGITS`` digits for each row of bit sums: the sums, several times over, change signs, a Hadamard transform mixes them, the largest counts.

    Sums of very long texts lose their lowest bits, so that mixed ones stay within 16 bits by far more than chance allows.
    """
    times = sides // SUMS
    most, shift = 8 * np.sqrt(times * (sums.astype(float) ** 2).sum(1)), np.zeros(len(sums), np.int64)
    while (big := most / 2.0**shift > 31_000).any():
        shift += big
    x = (np.tile((sums >> shift[:, None]).astype(np.int16).T, (times, 1))[:, :, None] * _signs(sides)[:, None, :]).reshape(sides, -1)
    step = 1
    while step < sides:
        y = x.reshape(-1, 2, step, x.shape[1])
        x = np.stack([y[:, 0] + y[:, 1], y[:, 0] - y[:, 1]], axis=1).reshape(x.shape)
        step *= 2
    at = np.ascontiguousarray(np.abs(x).T).argmax(1)
    return (at * 2 + (x[at, np.arange(len(at))] > 0)).astype(np.int16).reshape(len(sums), DIGITS)


def parities(found: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls into each of ``64 * SKETCH`` places; two of them differ in no more places than the sets in members."""
    return np.packbits((np.bincount(found & 64 * SKETCH - 1, minlength=64 * SKETCH) & 1).astype(np.uint8)).view(np.int64)


def _hashes(text: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a text's lower-cased words."""
    words = F.trim(F.regexp_replace(ascii_lower(text), r"[ \t-\r]+", " "))
    return F.xxhash64(words), F.xxhash64(F.lit(1), words)


def _told_apart(node: Column, check: Column, apart: dict[int, int]) -> Column:
    """What stands for a text: its first hash, or the second one if another text has the same first one. ``apart`` has the least second hash of each such first one."""
    if not apart:
        return node
    least = F.create_map(*(F.lit(x).cast("long") for pair in apart.items() for x in pair))[node]
    return F.when(least.isNull() | (least == check), node).otherwise(check)


def _node(text: Column, apart: dict[int, int]) -> Column:
    return _told_apart(*_hashes(text), apart)


def _shingles(text: Column, width: int) -> Column:
    @F.pandas_udf("array<long>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(t, width) for t in texts], dtype=object)

    return run(text)


def marked_texts(docs: DataFrame, width: int = WIDTH, sides: int = SIDES) -> DataFrame:
    """``doc_id``, ``node`` and ``check`` (two hashes of the text), ``n`` different shingles, ``digits``, ``ring`` (the low byte of each, eight in a long), ``sketch``."""

    @F.pandas_udf("n int, digits array<short>, ring array<long>, sketch array<long>")
    def run(texts: pd.Series) -> pd.DataFrame:
        sizes, made, rings, sketches = [], [], [], []
        for at in range(0, len(texts), TOGETHER):
            sets = [shingles(t, width) for t in texts[at : at + TOGETHER]]
            sizes += map(len, sets)
            found = digits(np.array([bit_sums(s) for s in sets]), sides)
            made += list(found)
            rings += list(found.astype(np.uint8).view(np.int64))
            sketches += map(parities, sets)
        return pd.DataFrame({"n": sizes, "digits": made, "ring": rings, "sketch": sketches})

    node, check = _hashes(F.col("text"))
    return docs.select("doc_id", node.alias("node"), check.alias("check"), run("text").alias("r")).select("doc_id", "node", "check", "r.*")


def _rows(texts: DataFrame, sides: int) -> DataFrame:
    """Each text under its keys: a digit, which of the next ``GAPS`` is equal too, both digits; ``window`` has the other digits of the third share."""
    size = (2 * sides - 1).bit_length()
    digit = lambda k: F.get("digits", F.pmod(F.col("at") + k, F.lit(DIGITS)))
    opened = texts.select("node", "n", "digits", F.explode(F.sequence(F.lit(0), F.lit(DIGITS * GAPS - 1))).alias("e"))
    placed = opened.select("node", "n", "digits", "e", F.floor(F.col("e") / GAPS).cast("int").alias("at"), (F.col("e") % GAPS + 1).alias("gap"))
    key = (F.col("e").cast("long") * (1 << 2 * size)) + digit(F.lit(0)).cast("long") * (1 << size) + digit(F.col("gap")).cast("long")
    others = [digit(F.lit(t) + (F.lit(t) >= F.col("gap")).cast("int")).cast("long").bitwiseAND(F.lit((1 << WINDOW_BITS) - 1)) for t in range(1, WINDOW - 1)]
    window = sum((o * (1 << WINDOW_BITS * k) for k, o in enumerate(others)), F.lit(0).cast("long"))
    return placed.select(key.alias("key"), "node", "n", window.alias("window"))


def _third(x: str, y: str) -> Column:
    """Whether a digit of two windows is equal in the bits that they hold."""
    differ = F.col(x).bitwiseXOR(F.col(y))
    return reduce(or_, (F.shiftright(differ, WINDOW_BITS * k).bitwiseAND(F.lit((1 << WINDOW_BITS) - 1)) == 0 for k in range(WINDOW - 2)))


def _rings_close(x: str, y: str) -> Column:
    """Whether at most ``FAR`` digits differ, as far as their low bytes tell."""
    wrong = F.lit(0)
    for k in range(DIGITS // 8):
        differ = F.col(x)[k].bitwiseXOR(F.col(y)[k])
        for shift in (4, 2, 1):  # a byte's lowest bit is set if any of its bits is
            differ = differ.bitwiseOR(F.shiftrightunsigned(differ, shift))
        wrong = wrong + F.bit_count(differ.bitwiseAND(F.lit(0x0101010101010101)))
    return wrong <= FAR


def _sets_close(x: str, y: str, n: str, m: str) -> Column:
    """Whether two sets may be similar enough, by their sizes and by their sketches, which differ in no more places than they in members."""
    differ = sum((F.bit_count(F.col(x)[k].bitwiseXOR(F.col(y)[k])) for k in range(SKETCH)), F.lit(0))
    return (UNDER * F.least(n, m) >= OVER * F.greatest(n, m)) & ((OVER + UNDER) * differ <= (UNDER - OVER) * (F.col(n) + F.col(m)))


def _alike(rows: DataFrame, others: DataFrame, apart: Column) -> DataFrame:
    """``a`` and ``b``, distinct: texts of ``rows`` and ``others`` that meet under a key and may be similar; columns of ``others`` end in 2 in ``apart``."""
    right = others.select(*(F.col(c).alias(f"{c}2") for c in others.columns))
    meet = (F.col("key") == F.col("key2")) & apart & _third("window", "window2") & _rings_close("ring", "ring2") & _sets_close("sketch", "sketch2", "n", "n2")
    return rows.join(right, meet).select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()


def _verified(pairs: DataFrame, docs: DataFrame, width: int, apart: dict[int, int]) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``, distinct) whose whole sets are similar enough."""
    ends = stage(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct(), "ends")
    ends = F.broadcast(ends) if ends.count() <= BROADCAST_IDS else ends
    texts = docs.select(_node(F.col("text"), apart).alias("node"), "text").join(ends, "node", "left_semi").dropDuplicates(["node"])
    sets = stage(texts.select("node", _shingles(F.col("text"), width).alias("all")), "sets")
    left, right = sets.select(F.col("node").alias("a"), F.col("all").alias("x")), sets.select(F.col("node").alias("b"), F.col("all").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "a").join(right, "b").where((OVER + UNDER) * both >= OVER * (F.size("x") + F.size("y"))).select("a", "b")


def _prefixes(docs: DataFrame, width: int, apart: dict[int, int]) -> DataFrame:
    """``key`` and ``node``: each different text under the first of its shingles in the order of their hashes, as many as leave too few for the similarity."""

    @F.pandas_udf("array<long>")
    def run(texts: pd.Series) -> pd.Series:
        found = (shingles(t, width) for t in texts)
        return pd.Series([f[: len(f) - -(-len(f) * OVER // UNDER) + 1] for f in found], dtype=object)

    each = docs.select(_node(F.col("text"), apart).alias("node"), run("text").alias("keys")).dropDuplicates(["node"])
    return each.select(F.explode("keys").alias("key"), "node")


def _missed(docs: DataFrame, texts: DataFrame, parts: DataFrame, width: int, apart: dict[int, int]) -> DataFrame:
    """``a`` and ``b``: all similar texts of different ``parts``, found by their prefixes."""
    rows = stage(_prefixes(docs, width, apart), "prefixes")
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key")
    told = stage(texts.select("node", "n", "sketch").join(parts, "node", "left").withColumn("part", F.coalesce("part", "node")), "told")
    met = stage(rows.join(shared, "key").join(told, "node").select("key", "node", "n", "sketch", "part"), "prefixes-met")
    right = met.select(*(F.col(c).alias(f"{c}2") for c in met.columns))
    meet = (F.col("key") == F.col("key2")) & (F.col("node") < F.col("node2")) & (F.col("part") != F.col("part2")) & _sets_close("sketch", "sketch2", "n", "n2")
    pairs = stage(met.join(right, meet).select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct(), "missed")
    return _verified(pairs, docs, width, apart)


def link_texts(marked: DataFrame, docs: DataFrame, width: int, exact: bool, told: dict[int, int], sides: int = SIDES) -> DataFrame:
    """``node`` and ``root`` of the texts of ``docs``, of which ``marked`` is made, that have a link; the root is the group's smallest node."""
    drawn = marked.groupBy("node").agg(*(F.first(c).alias(c) for c in ("n", "digits", "ring", "sketch")))
    texts = stage(drawn.repartition(shuffle_partitions(marked.sparkSession), "node"), "texts")  # many tasks open the keys
    rows = _rows(texts, sides)
    shared = stage(rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "keys")
    met = stage(rows.join(shared, "key"), "met")

    score = met.groupBy("node").agg(F.sum("size").alias("score"))
    about = stage(texts.select("node", "ring", "sketch").join(score, "node"), "about")
    center = stage(met.select("key", "node").join(about.select("node", "score"), "node").groupBy("key").agg(F.max_by("node", "score").alias("center")), "center")
    full = met.join(about, "node").join(center, "key").select("key", "node", "n", "window", "ring", "sketch", (F.col("node") == F.col("center")).alias("central"))
    full = stage(full, "full")
    star = stage(_alike(full.where("not central"), full.where("central"), F.lit(True)), "star")
    drawn = stage(_verified(star, docs, width, told), "drawn")
    parts = stage(connected_components(drawn), "parts").withColumnRenamed("root", "part")

    placed = full.join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    sized = placed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("held")).groupBy("key").agg(F.max_by("part", "held").alias("most"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    apart = placed.join(stage(sized, "sized"), "key").select("key", "node", "n", "window", "ring", "sketch", "part", (F.col("part") == F.col("most")).alias("main"))
    apart = stage(apart, "apart")
    pairs = stage(_alike(apart.where("not main"), apart, (F.col("part") != F.col("part2")) & (F.col("main2") | (F.col("node") < F.col("node2")))), "pairs")
    links = drawn.union(_verified(pairs, docs, width, told))
    groups = stage(connected_components(links), "groups")
    if not exact:
        return groups
    return stage(connected_components(links.union(_missed(docs, texts, groups.withColumnRenamed("root", "part"), width, told))), "all-groups")


def similar_texts(docs: DataFrame, width: int = WIDTH, exact: bool = False, sides: int = SIDES) -> DataFrame:
    """A row per document: ``doc_id``, ``component_id``: the smallest doc_id that links reach, its own included.

    ``exact`` loses no link, for more work: by itself the fingerprints' keys miss some pairs of a similarity below 0.85.
    ``sides``, a power of two from ``SUMS`` to ``MOST_SIDES``, is for the number of different texts; see :func:`sides_for`.

    Null texts count as empty, and texts without words are alike. A null id is never the smallest and the component of
    documents without any id is null. Rows that share an id are judged each by their text. An empty table gives an
    empty result; columns but ``doc_id`` and ``text`` are not read.
    """
    if sides not in (1 << k for k in range(SUMS.bit_length() - 1, MOST_SIDES.bit_length())):
        raise ValueError(f"sides must be a power of two from {SUMS} to {MOST_SIDES}")
    slim = id_and_text(docs)
    marked = stage(marked_texts(slim, width, sides), "rings")
    ids = [F.min("doc_id").alias("first"), F.min("check").alias("low"), F.max("check").alias("high")]
    first = stage(marked.groupBy("node").agg(*ids), "first")
    told = {r["node"]: r["low"] for r in first.where("low <> high").select("node", "low").collect()}  # hashes that texts share by chance: none below billions of texts
    if told:
        marked = marked.withColumn("node", _told_apart(F.col("node"), F.col("check"), told))
        first = stage(marked.groupBy("node").agg(*ids), "first")
    groups = link_texts(marked, slim, width, exact, told, sides)
    smallest = groups.join(first, "node").groupBy("root").agg(F.min("first").alias("component_id"))
    linked = groups.join(smallest, "root").select("node", "component_id")
    all_of = stage(first.select("node", "first").join(linked, "node", "left").select("node", F.coalesce("component_id", "first").alias("component_id")), "components")
    return marked.select("doc_id", "node").join(all_of, "node").select("doc_id", "component_id")


def drop_similar_texts(docs: DataFrame, width: int = WIDTH, exact: bool = False, sides: int = SIDES) -> DataFrame:
    """``docs`` with one document of each group of :func:`similar_texts`, the one with the smallest id; rows without an id stay.

    Rows that share an id are one document and stay or go together.
    """
    gone = similar_texts(docs, width, exact, sides).where("doc_id <> component_id").select(F.col("doc_id").alias("__id")).distinct()
    gone = stage(gone, "copies")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(gone, docs["doc_id"] == gone["__id"], "left_anti")
