"""Best-fit packing with exact complements.

Which pieces share a sequence depends on their lengths alone, and there are at most ``CAPACITY`` lengths. So the
corpus is counted by length, the plan is made on the counts, and each piece finds its place by its length and its
rank among the pieces of that length. The plan works through the lengths from the longest: the gap that a piece leaves
is looked up by hash among the single lengths and in an index of the sums of pairs and triples still available; a
combination that fills it exactly is used as often as its lengths last. The index holds the best combination of each sum
asked for and is mended when its lengths run out. Where no combination does, the longest piece that fits goes in and the
rest of the gap is looked up again.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossaria.llm.chunks import ChunkEncoder, slices
from glossaria.llm.common import bound_batches, id_and_text, stage, table

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 2048
#: The id that closes each document.
END_ID = 0
#: Pieces of one length that a task ranks; a length that more pieces share is dealt out to several.
RANKED_TOGETHER = 1_000
#: Bytes of text that a worker holds the ids of, and chunks that the tokenizer gets at once.
BATCH_BYTES, TOGETHER = 2 << 20, 1000


class _Tokens:
    """Ids of chunks by the tokenizers library."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Byte-level tokens are spelled with a character for each byte, so their lengths tell where a chunk's ids end.
        self.sizes = np.array([len(self.tokenizer.id_to_token(i)) for i in range(self.tokenizer.get_vocab_size())])
        self.chunks = ChunkEncoder(self._chunks)

    def _chunks(self, chunks: list[str], heads: int) -> list[bytes]:
        """Texts' first chunks go to the tokenizer each alone, the others in rows, as in a text, and are told apart by their bytes."""
        alone = self.tokenizer.encode_batch_fast(chunks[:heads], add_special_tokens=False)
        out = [np.array(x.ids, "<u4").tobytes() for x in alone]
        for at in range(heads, len(chunks), TOGETHER):
            part = chunks[at : at + TOGETHER]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, np.int64)
            ends = np.cumsum([len(c.encode()) for c in part])
            cuts = (4 * np.searchsorted(np.cumsum(self.sizes[ids]), ends, side="right")).tolist()
            data = ids.astype("<u4").tobytes()
            out += [data[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
        return out


@lru_cache(maxsize=2)
def _tokens(path: str) -> _Tokens:
    return _Tokens(path)


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row per piece of a document's ids with the closing id: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, and ``ids`` if asked for.

    Documents of more than ``capacity`` ids are cut so that all pieces but the first are full. A null text is empty
    and still has the closing id, so every row of ``docs`` has a piece. Other columns are not read.
    """
    slim = id_and_text(docs)
    kind = dict(slim.dtypes)["doc_id"]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _tokens(path or public_tokenizers.path(VOCABULARY))
        for batch in batches:
            for at, texts in slices(batch.column(1), BATCH_BYTES):
                yield cut_up(batch.column(0), at, encoder.chunks(texts))

    def cut_up(doc_ids: pa.Array, first: int, encoded: list[bytes]) -> pa.RecordBatch:
        end, row, piece, start, length, crc, kept = END_ID.to_bytes(4, "little"), [], [], [], [], [], []
        for i, ids in enumerate(encoded, first):
            whole = ids + end
            n = len(whole) // 4
            parts = -(-n // capacity)
            at = 0
            for k in range(parts):
                till = n - (parts - 1 - k) * capacity
                data = whole[4 * at : 4 * till]
                row.append(i)
                piece.append(k)
                start.append(at)
                length.append(till - at)
                crc.append(zlib.crc32(data))
                if with_ids:
                    kept.append(data)
                at = till
        columns = [doc_ids.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
        return pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * with_ids, names=names)

    return slim.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


class Plan:
    """Patterns of lengths and how often each is used, made from the number of pieces of each length."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.counts = self.left.copy()  # as ``left``, but for the lengths that a pattern in the making holds
        #: The index: the longer length of a pair by its sum, the longest of a triple by its sum.
        self.pairs: dict[int, int] = {}
        self.triples: dict[int, int] = {}
        self.patterns: list[tuple[list[int], int]] = []
        while len(found := np.flatnonzero(self.left)):
            self._use(self._pattern(int(found[-1])))

    def _use(self, pattern: list[int]) -> None:
        need = Counter(pattern)
        times = min(int(self.left[x]) // n for x, n in need.items())
        for x, n in need.items():
            self.left[x] -= n * times
        self.counts = self.left.copy()
        self.patterns.append((pattern, times))

    def _pattern(self, longest: int) -> list[int]:
        """The lengths of the next sequence; takes none of them away yet."""
        pattern, gap, before = [longest], self.capacity - longest, self.left.copy()
        self.left[longest] -= 1
        while gap:
            if exact := self.exact(gap):
                pattern += exact
                break
            fits = np.flatnonzero(self.left[: gap + 1])
            if not len(fits):
                break
            pattern.append(int(fits[-1]))
            self.left[pattern[-1]] -= 1
            gap -= pattern[-1]
        self.left = before
        return pattern

    def exact(self, gap: int) -> list[int]:
        """The single length, pair or triple that fills ``gap``, of the longest lengths that do; empty if none does."""
        if self.left[gap]:
            return [gap]
        return self._pair(gap, gap) or self._triple(gap)

    def _pair(self, total: int, most: int) -> list[int]:
        """Two lengths, none over ``most``, of the sum ``total``."""
        high = self._indexed_pair(total)
        if not high:
            return []
        if high > most or not self._two(self.left, high, total - high):  # too long here, or used by the pattern itself
            high = self._search_pair(self.left, total, min(most, high))
        return [high, total - high] if high else []

    def _indexed_pair(self, total: int) -> int:
        """The longer length of the pair of this sum that the index holds; 0 for none. Counts only fall, so what is gone is never looked for again."""
        high = self.pairs.get(total, total - 1)
        if high and not self._two(self.counts, high, total - high):
            high = self._search_pair(self.counts, total, high)
        self.pairs[total] = high
        return high

    @staticmethod
    def _two(counts: np.ndarray, high: int, low: int) -> bool:
        return low > 0 and counts[low] > 0 and counts[high] > (high == low)

    @staticmethod
    def _search_pair(counts: np.ndarray, total: int, most: int) -> int:
        high = np.arange(min(most, total - 1), (total - 1) // 2, -1)
        if not len(high):
            return 0
        low = total - high
        ok = (counts[high] > 0) & (counts[low] > 0) & ((high != low) | (counts[high] > 1))
        at = int(ok.argmax())
        return int(high[at]) if ok[at] else 0

    def _triple(self, total: int) -> list[int]:
        """Three lengths of the sum ``total``; the index holds the longest of the first triple that is left."""
        first = self.triples.get(total, total - 2)
        lengths = np.flatnonzero(self.counts[: max(first, 0) + 1])[::-1]
        gone = True
        for a in lengths[lengths * 3 >= total].tolist():
            rest = self._indexed_pair(total - a)
            if not rest or rest > a and not self._search_pair(self.counts, total - a, a):
                continue
            if gone:
                self.triples[total], gone = a, False
            if self.left[a]:
                self.left[a] -= 1
                two = self._pair(total - a, a)
                self.left[a] += 1
                if two:
                    return [a, *two]
        if gone:
            self.triples[total] = 0
        return []

    def slots(self) -> list[tuple[int, int, int, int, int]]:
        """``length``, first rank, rank after the last, first sequence, place in the sequence: where the pieces of a length go."""
        out, used, base = [], Counter(), 0
        for pattern, times in self.patterns:
            at = 0
            for x in pattern:
                out.append((x, used[x], used[x] + times, base, at))
                used[x] += times
                at += x
            base += times
        return out


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a table of pieces with ``doc_id``, ``piece``, ``start`` and ``length``.

    Pieces must be no longer than ``capacity``. The same pieces always get the same places; rows that repeat in these
    columns get one place each. An empty table gives an empty result. The plan is a small literal table, bounded by
    the capacity and not by the corpus; pieces are ranked in groups of bounded size, however many share a length.
    """
    spark = found.sparkSession
    counts = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}  # at most one row for each length
    slots = spark.createDataFrame(Plan(counts, capacity).slots(), "__length long, __from long, __till long, __base long, offset long")
    groups = spark.createDataFrame([(x, -(-n // RANKED_TOGETHER)) for x, n in counts.items()], "length long, __groups long")
    key = ["length", "__group"]
    dealt = found.join(F.broadcast(groups), "length").withColumn("__group", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.col("__groups"))).drop("__groups")
    sizes = dealt.groupBy(key).agg(F.count(F.lit(1)).alias("__size"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__size").over(Window.partitionBy("length").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__size")
    order = Window.partitionBy(key).orderBy("doc_id", "piece", "start")
    ranked = dealt.withColumn("__rank", F.row_number().over(order) - 1).join(before, key).withColumn("__rank", F.col("__rank") + F.col("__before"))
    here = (F.col("length") == F.col("__length")) & (F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__till"))
    placed = ranked.join(F.broadcast(slots), here).withColumn("sequence_id", F.col("__base") + F.col("__rank") - F.col("__from"))
    return placed.select(*(F.col(f"`{c}`") for c in found.columns if c not in ("sequence_id", "offset")), "sequence_id", "offset")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """:func:`pieces` of ``docs``, tokenized once, with their places from :func:`pack`."""
    return pack(stage(pieces(docs, capacity, path, with_ids), "pieces"), capacity)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return pack_documents(table(spark, sf_dir, "documents")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES = {"op7_best_fit_packing": op7_best_fit_packing}
SQL: dict[str, str] = {}
