"""Mixture-controlled packing: deficit round-robin over queues of sources.

Each source is a queue of packets, runs of at most ``GRAIN`` ids of one document. In each round a source's deficit grows
by its share of a window, and it sends packets while the deficit lasts; what is left of the deficit goes on to the next
round. So a packet's round follows from how many of its source's ids come up to its end, and no queue has to be walked
through: blocks of documents carry the totals of the blocks before them, per source. Rounds are laid end to end, the
sources of a round in turn, and cut into windows, so every window has each source's share to within two packets, whatever
the sources' sizes. The last window, where it isn't full, is cut at powers of two: nothing is padded.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossaria.llm.chunks import ChunkEncoder, slices
from glossaria.llm.common import bound_batches, stage, table

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
#: The id that closes each document.
END_ID = 1
#: Ids of a packet at most: how far a source may be ahead of or behind its share.
GRAIN = 64
#: Bytes of text that a worker holds the ids of, and chunks that the tokenizer gets at once.
BATCH_BYTES, TOGETHER = 2 << 20, 1000
#: A character that is a token by itself where white space surrounds it.
SEPARATOR = "\x01"


class _Words:
    """Ids by the tokenizers library. White space is dropped and never part of a token, so texts may be cut at any."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        (self.separator,) = self.tokenizer.encode(SEPARATOR).ids
        self.chunks = ChunkEncoder(self._chunks)

    def __call__(self, texts: pa.Array) -> list[bytes]:
        """The ids of each whole text."""
        return self.chunks(_spelled_alike(texts))

    def _chunks(self, chunks: list[str], heads: int) -> list[bytes]:
        """Texts' first chunks, and those that hold the separator, go to the tokenizer each alone, the others in rows with a separator between them."""
        ids = lambda texts: [np.array(x.ids, "<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        out = [x.tobytes() for x in ids(chunks[:heads])]
        for at in range(heads, len(chunks), TOGETHER):
            part = chunks[at : at + TOGETHER]
            (row,) = ids([f" {SEPARATOR}".join(part)])
            cuts = np.flatnonzero(row == self.separator)
            if len(cuts) >= len(part):
                out += [x.tobytes() for x in ids(part)]
                continue
            data, begins, ends = row.tobytes(), [0, *(4 * (cuts + 1)).tolist()], [*(4 * cuts).tolist(), 4 * len(row)]
            out += [data[a:b] for a, b in zip(begins, ends, strict=True)]
        return out


def _spelled_alike(texts: pa.Array) -> pa.Array:
    """The texts in a spelling that has the same ids and fewer different chunks: A-Z lower-cased, one space for white space, one before punctuation.

    The tokenizer does the same, after it has looked for special tokens and put letters and their marks together; so texts
    where that might tell stay as they are.
    """
    texts = texts.cast(pa.string())
    apart = pc.match_substring_regex(texts, r"<\||[A-Z]\p{M}")
    plain = pc.replace_substring_regex(pc.ascii_lower(texts), r"[\t-\r][\t-\r ]*| [\t-\r ]+", " ")
    return pc.if_else(apart, texts, pc.replace_substring_regex(plain, r"([a-z0-9])([.,;:!?])", r"\1 \2"))


@lru_cache(maxsize=2)
def _words(path: str) -> _Words:
    return _Words(path)


def token_rows(docs: DataFrame, path: str | None = None) -> DataFrame:
    """A row per document: ``doc_id``, ``source`` (its queue, ``=`` before the name; empty for null), ``uid``, ``block``, ``before``, ``n``, ``ids``.

    ``n`` counts the ids with the closing one; ``before`` those that the document's source has before it in the block, a
    task's rows; ``uid`` tells rows apart. ``ids`` are little-endian and compressed.
    """
    kind = dict(docs.dtypes)["doc_id"]
    source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    slim = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), source.alias("source"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, pack, block, row, before = _words(path or public_tokenizers.path(VOCABULARY)), zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId(), 0, Counter()
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            for at, texts in slices(batch.column(1), BATCH_BYTES):
                here, begins, sizes, packed = batch.slice(at, len(texts)), [], [], []
                for queue, ids in zip(here.column(2).to_pylist(), words(texts), strict=True):
                    begins.append(before[queue])
                    sizes.append(len(ids) // 4 + 1)
                    before[queue] += sizes[-1]
                    packed.append(pack.compress(np.frombuffer(ids + end, "<u4").astype(words.width).tobytes()))
                uids = np.arange(row, row + len(texts)) + (block << 33)
                row += len(texts)
                columns = [here.column(0), here.column(2), *(pa.array(x, pa.int64()) for x in (uids, np.full(len(texts), block), begins, sizes)), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "source", "uid", "block", "before", "n", "ids"])

    return slim.mapInArrow(run, f"doc_id {kind}, source string, uid long, block long, before long, n long, ids binary")


def _running(df: DataFrame, by: list[str], value: str, out: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the blocks before a row's, for one row per block (and ``by``)."""
    before = Window.partitionBy(*by).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.coalesce(F.sum(value).over(before), F.lit(0)))


def _packets(rows: DataFrame, capacity: int, grain: int, targets: dict[str | None, float] | None) -> DataFrame:
    """``uid``, ``start``, ``length`` of each packet, its ``source``, ``till`` (the source's ids up to its end) and its ``round``.

    A source's share is that of its target among all targets; without targets, and for sources without one, it is its
    share of all ids, so that all queues end together.
    """
    spark = rows.sparkSession
    blocks = stage(rows.groupBy("source", "block").agg(F.sum("n").alias("here")), "mixture-blocks")
    sums = blocks.groupBy("source").agg(F.sum("here").alias("total"))
    total = blocks.agg(F.sum("here")).first()[0]
    share = F.col("total") / F.lit(float(total))
    if targets:
        given = [("" if s is None else f"={s}", w / sum(targets.values())) for s, w in targets.items()]
        sums = sums.join(spark.createDataFrame(given, "source string, target double"), "source", "left")
        share = F.coalesce("target", share)
    bases = _running(blocks, ["source"], "here", "base").join(sums.select("source", share.alias("share")), "source").select("source", "block", "base", "share")
    placed = rows.select("uid", "source", "block", "before", "n").join(bases, ["source", "block"])
    each = placed.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(grain).cast("long"))))
    length = F.least(F.lit(grain).cast("long"), F.col("n") - F.col("start"))
    sent = each.select("uid", "source", "start", length.alias("length"), (F.col("base") + F.col("before") + F.col("start") + length).alias("till"), "share")
    return sent.select("uid", "source", "start", "length", "till", (F.ceil(F.col("till") / (F.col("share") * F.lit(float(capacity)))) - 1).cast("long").alias("round"))


def _laid_out(packets: DataFrame) -> DataFrame:
    """``uid``, ``start``, ``length``, ``at`` (the ids before the packet in its block) and ``block``: rounds end to end, blocks being the tasks of the sort."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            ends = at + np.cumsum(batch.column(2).to_numpy())
            columns = [*batch.columns, pa.array(ends - batch.column(2).to_numpy()), pa.array(np.full(len(batch), block))]
            at = int(ends[-1]) if len(ends) else at
            yield pa.RecordBatch.from_arrays(columns, names=["uid", "start", "length", "at", "block"])

    ordered = packets.orderBy("round", "source", "till").select("uid", "start", "length")
    return ordered.mapInArrow(run, "uid long, start long, length long, at long, block long")


def _bounds(total: int, capacity: int) -> tuple[np.ndarray, int]:
    """Where the sequences of the last window begin, powers of two from the largest, and how many windows are full."""
    full, rest = divmod(total, capacity)
    sizes = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return full * capacity + np.cumsum([0, *sizes])[:-1].astype(np.int64), full


def _cut(row: np.ndarray, start: np.ndarray, length: np.ndarray, pos: np.ndarray, total: int, capacity: int) -> list[np.ndarray]:
    """Packets (ordered by row and start) as pieces: ``row``, ``start``, ``length``, ``sequence_id``, ``offset``; cut where sequences end, neighbours put together."""
    tail, full = _bounds(total, capacity)
    first, last = pos // capacity, (pos + length - 1) // capacity
    over = np.repeat(np.arange(len(pos)), last - first + 1)
    window = first[over] + np.arange(len(over)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1)
    begin, end = np.maximum(pos[over], window * capacity), np.minimum((pos + length)[over], (window + 1) * capacity)
    if len(tail):  # what lies in the last window is cut once more
        parts = np.where(window == full, np.searchsorted(tail, end - 1, side="right") - np.searchsorted(tail, begin, side="right") + 1, 1)
        again = np.repeat(np.arange(len(over)), parts)
        kth = np.arange(len(again)) - np.repeat(np.cumsum(parts) - parts, parts)
        over, window, begin, end = over[again], window[again], begin[again], end[again]
        late = window == full
        which = np.searchsorted(tail, begin, side="right") - 1 + kth
        ends = np.append(tail[1:], total)
        low, high = tail[np.clip(which, 0, len(tail) - 1)], ends[np.clip(which, 0, len(tail) - 1)]
        begin, end = np.where(late, np.maximum(begin, low), begin), np.where(late, np.minimum(end, high), end)
        sequence, origin = np.where(late, full + which, window), np.where(late, low, window * capacity)
    else:
        sequence, origin = window, window * capacity
    row, start, size = row[over], start[over] + begin - pos[over], end - begin
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (sequence[1:] != sequence[:-1]) | (begin[1:] != end[:-1]) | (start[1:] != start[:-1] + size[:-1])
    at = np.flatnonzero(new)
    return [row[at], start[at], np.add.reduceat(size, at) if len(at) else size, sequence[at], (begin - origin)[at]]


def mix_documents(docs: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN, targets: dict[str | None, float] | None = None, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row per piece of a document: ``doc_id``, ``source``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``, and ``ids`` if asked for.

    ``targets`` has a weight for each source (``None`` for documents without one) and need not name all; a queue that
    ends before the others leaves its share to them. A null text is empty and still has the closing id. Rows that repeat
    each get a place; an empty table gives an empty result; columns but ``doc_id``, ``text`` and ``source`` are not read.
    """
    if not 0 < grain <= capacity:
        raise ValueError("a packet must fit into a window")
    if targets is not None and not all(0 < w < float("inf") for w in targets.values()):
        raise ValueError("a target is a number above 0")
    kind, width = dict(docs.dtypes)["doc_id"], None
    names = ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    schema = f"doc_id {kind}, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids
    spark = docs.sparkSession
    rows = stage(token_rows(docs, path), "mixture-rows")
    total = rows.agg(F.sum("n")).first()[0]
    if not total:
        return spark.createDataFrame([], schema)
    width = _words(path or public_tokenizers.path(VOCABULARY)).width
    laid = stage(_laid_out(_packets(rows, capacity, grain, targets)), "mixture-order")
    blocks = _running(laid.groupBy("block").agg(F.sum("length").alias("here")).withColumn("all", F.lit(0)), ["all"], "here", "base").select("block", "base")  # a row for each task
    packet = F.struct("start", "length", (F.col("base") + F.col("at")).alias("pos"))
    found = laid.join(blocks, "block").groupBy("uid").agg(F.sort_array(F.collect_list(packet)).alias("packets"))
    whole = rows.select("uid", "doc_id", "source", "n", "ids").join(found, "uid").select("doc_id", "source", "n", "ids", "packets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            packets = batch.column(4)
            held = packets.flatten()
            row = np.repeat(np.arange(len(batch)), np.diff(packets.offsets.to_numpy()))
            cut = _cut(row, *(held.field(k).to_numpy() for k in range(3)), total, capacity)
            crc, kept, at, data = [], [], -1, b""
            ids = batch.column(3)
            for i, start, length in zip(*(x.tolist() for x in cut[:3]), strict=True):
                if i != at:
                    at, data = i, memoryview(np.frombuffer(unpack.decompress(ids[i].as_py()), width).astype("<u4").tobytes())
                crc.append(zlib.crc32(data[4 * start : 4 * (start + length)]))
                if with_ids:
                    kept.append(bytes(data[4 * start : 4 * (start + length)]))
            of = pa.array(cut[0])
            queue = batch.column(1).take(of)
            source = pa.array([s[1:] if s else None for s in queue.to_pylist()], pa.string())
            columns = [batch.column(0).take(of), source, pa.array(cut[1]), pa.array(cut[2]), pa.array(crc, pa.int64()), batch.column(2).take(of), pa.array(cut[3]), pa.array(cut[4])]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * with_ids, names=names)

    return whole.mapInArrow(run, schema)


def op12_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return mix_documents(table(spark, sf_dir, "documents")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


QUERIES = {"op12_mixture_packing": op12_mixture_packing}
SQL: dict[str, str] = {}
