"""Alignment of two tokenizers over the same bytes, and how often each pair of ids is linked in the corpus.

Tokens of either side are told by where they end in the text's bytes. Ends are compared along a diagonal, at the current
shift between the indices: runs of twice the length each are compared whole, then halves, which jumps over a stretch
where both sides cut alike. At the first difference the group is resolved by itself, token by token until the ends meet,
and the shift is updated. Neither tokenizer joins what a single space parts, so a text is aligned by the chunks between
spaces, and those that come again are not aligned anew.

A chunk's alignment is its links in order, 32 bits each: the pair of ids, whether it begins a group, and whether it is
the pair before once more. Pairs are counted corpus-wide by one aggregation. A block of documents then gets the counts
of the pairs that it has, once each, and not one row for every link.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaria.llm.chunks import _SPACE, ChunkEncoder, slices
from glossaria.llm.common import bound_batches, stage, table

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text that a worker aligns at once, and those whose documents are a block.
BATCH_BYTES, BLOCK_BYTES = 1 << 20, 8 << 20
#: What stands in place of links where the bytes of the two sides differ.
UNEQUAL = 0xFFFFFFFF


def aligned(ends_a: np.ndarray, ends_b: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Groups of two ascending arrays of ends with the same last one: ``(i, p, j, q)``, indices from i to before p on one side, from j to before q on the other.

    A stretch of tokens that end alike one by one is one entry, with as many on either side as groups.
    """
    a, b = np.ascontiguousarray(ends_a, "<i8").tobytes(), np.ascontiguousarray(ends_b, "<i8").tobytes()
    to_a, to_b, n = ends_a.tolist(), ends_b.tolist(), len(ends_a)
    out, i, j = [], 0, 0
    while i < n:
        run, k = 0, 1
        while i + run + k <= n and a[8 * (i + run) : 8 * (i + run + k)] == b[8 * (j + run) : 8 * (j + run + k)]:
            run, k = run + k, 2 * k
        while k > 1:
            k //= 2
            if i + run + k <= n and a[8 * (i + run) : 8 * (i + run + k)] == b[8 * (j + run) : 8 * (j + run + k)]:
                run += k
        if run:
            out.append((i, i + run, j, j + run))
            i, j = i + run, j + run
            if i == n:
                break
        p, q = i, j
        while to_a[p] != to_b[q]:
            if to_a[p] < to_b[q]:
                p += 1
            else:
                q += 1
        out.append((i, p + 1, j, q + 1))
        i, j = p + 1, q + 1
    return out


class _Sides:
    """Both tokenizers, and the links of chunks of text."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.wide = self.b.get_piece_size()
        self.pairs = self.a.get_vocab_size() * self.wide
        if self.pairs + self.pairs + self.a.get_vocab_size() >= UNEQUAL:
            raise ValueError("the vocabularies have more pairs than a link can hold")
        shown = ByteLevel.alphabet()
        byte_of = dict(zip(sorted(shown, key=lambda c: (ord(c) > 255, ord(c))), sorted(range(256), key=lambda x: (chr(x) not in shown, x)), strict=True))
        special = {i: t.content.encode() for i, t in self.a.get_added_tokens_decoder().items()}
        self.bytes_a = [special.get(i) or bytes(byte_of[c] for c in self.a.id_to_token(i)) for i in range(self.a.get_vocab_size())]
        self.bytes_b = [bytes([int(t[3:5], 16)]) if self.b.is_byte(i) else t.replace("▁", " ").encode() for i in range(self.wide) for t in (self.b.id_to_piece(i),)]
        self.size_a, self.size_b = (np.array([len(x) for x in held], np.int64) for held in (self.bytes_a, self.bytes_b))
        self.chunks = ChunkEncoder(self._links)
        # Ids as text, each with what may follow it: a comma, the bar between the sides, the semicolon between groups.
        self.shown = pa.array([f"{i}{c}" for c in ",|;" for i in range(max(self.a.get_vocab_size(), self.wide))])
        self.step = len(self.shown) // 3

    def _links(self, texts: list[str], heads: int) -> list[bytes]:
        """Of each text, which but for the first ones begins with a space, the links as bytes; the first ones get theirs."""
        spaced = [f" {t}" for t in texts[:heads]] + texts[heads:]
        ids_a = [x.ids for x in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        ids_b = self.b.encode([t[1:] for t in spaced], num_threads=1)
        out, right = [np.array([UNEQUAL], "<u4").tobytes()] * len(texts), []
        for k, text in enumerate(spaced):
            raw = text.encode()
            if b"".join(map(self.bytes_a.__getitem__, ids_a[k])) == raw and b"".join(map(self.bytes_b.__getitem__, ids_b[k])) == raw:
                right.append(k)
        if right:
            for k, words in zip(right, self._linked([ids_a[k] for k in right], [ids_b[k] for k in right]), strict=True):
                out[k] = words
        return out

    def _linked(self, each_a: list[list[int]], each_b: list[list[int]]) -> list[bytes]:
        """Links of texts whose bytes are equal on both sides, aligned as one row of them."""
        ids_a, ids_b = (np.fromiter((i for x in each for i in x), np.int64) for each in (each_a, each_b))
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        till, words, count, wide, pairs = [], [], 0, self.wide, self.pairs
        at_a, at_b, to_a, to_b = ids_a.tolist(), ids_b.tolist(), ends_a.tolist(), ends_b.tolist()
        for i, p, j, q in aligned(ends_a, ends_b):
            if p - i == q - j and to_a[i] == to_b[j]:  # a stretch
                words += [pairs + x * wide + y for x, y in zip(at_a[i:p], at_b[j:q], strict=True)]
                till += [(k + 1, count + k + 1 - i) for k in range(i, p)]
                count += p - i
                continue
            words.append(pairs + at_a[i] * wide + at_b[j])
            while i < p - 1 or j < q - 1:
                if to_a[i] < to_b[j]:
                    i += 1
                    words.append(2 * pairs + at_a[i] if at_a[i] == at_a[i - 1] else at_a[i] * wide + at_b[j])
                else:
                    j += 1
                    words.append(at_a[i] * wide + at_b[j])
            count = len(words)
            till.append((p, count))
        ends = dict(till)
        data, out, at, last = np.array(words, "<u4").tobytes(), [], 0, 0
        for x in each_a:
            at += len(x)
            out.append(data[4 * last : 4 * ends[at]])
            last = ends[at]
        return out

    def read(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The pair of each link, and whether it begins a group, a token of the first side, one of the second."""
        words = words.astype(np.int64)
        again = words >= 2 * self.pairs
        new = (words >= self.pairs) & ~again
        held = np.maximum.accumulate(np.where(again, 0, np.arange(len(words))))
        code = np.where(new, words - self.pairs, words)[held]
        a = code // self.wide
        begins_a = new | again
        begins_a[1:] |= ~new[1:] & (a[1:] != a[:-1])
        return code, new, begins_a, new | ~begins_a


@lru_cache(maxsize=2)
def _sides(path_a: str, path_b: str) -> _Sides:
    return _Sides(path_a, path_b)


def _told(sides: _Sides, links: list[bytes]) -> tuple[dict[str, list], np.ndarray, np.ndarray, np.ndarray]:
    """Figures of documents by their links; each document's different pairs with how often it has them: document, pair, times."""
    links = [b"" if UNEQUAL in np.frombuffer(x, "<u4") else x for x in links]
    sizes = np.array([len(x) // 4 for x in links], np.int64)
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(links)), sizes)
    code, new, has_a, has_b = sides.read(np.frombuffer(b"".join(links), "<u4"))
    total = lambda x: np.bincount(doc[x], minlength=len(links))
    n_a, n_b, n_groups = total(has_a), total(has_b), total(new)

    # Groups as text: each token has its place, those of the first side before those of the second in a group.
    group = np.cumsum(new) - 1
    of_a, of_b = np.flatnonzero(has_a), np.flatnonzero(has_b)
    sizes_a, sizes_b = np.bincount(group[of_a], minlength=n_groups.sum()), np.bincount(group[of_b], minlength=n_groups.sum())
    done_a, done_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    rank_a, rank_b = np.arange(len(of_a)), np.arange(len(of_b))
    shown = np.empty(len(of_a) + len(of_b), np.int64)
    shown[rank_a + (done_b - sizes_b)[group[of_a]]] = code[of_a] // sides.wide + sides.step * (rank_a + 1 == done_a[group[of_a]])
    shown[rank_b + done_a[group[of_b]]] = code[of_b] % sides.wide + 2 * sides.step * (rank_b + 1 == done_b[group[of_b]])
    text = sides.shown.take(pa.array(shown))
    cuts = np.frombuffer(text.buffers()[1], np.int32, len(shown) + 1) if len(shown) else np.zeros(1, np.int32)
    data = memoryview(text.buffers()[2] or b"") if len(shown) else memoryview(b"")
    till = cuts[np.cumsum(n_a + n_b)].tolist()
    hashes = [hashlib.sha256(data[s : e - 1]).hexdigest() if e > s else "" for s, e in zip([0, *till], till, strict=False)]

    key, times = np.unique(doc * np.int64(1 << 32) + code, return_counts=True)
    return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": sizes, "groups_sha256": hashes}, key >> 32, key & (1 << 32) - 1, times


_FIGURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def linked_rows(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """A row per document (``doc_id``, its figures, ``pairs`` of ids as one number each, ``times``) and, with ``whole`` set, one per ``block`` of documents with the pairs that these have."""
    kind = dict(docs.dtypes)["doc_id"]
    slim = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    names = ["block", "whole", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sides = _sides(path_a or public_tokenizers.path(VOCABULARY_A), path_b or public_tokenizers.path(VOCABULARY_B))
        block, held, seen, id_kind = TaskContext.get().partitionId() << 32, [], 0, None
        for batch in batches:
            id_kind = batch.schema.field(0).type
            for at, texts in slices(batch.column(1), BATCH_BYTES):
                figures, doc, pair, times = _told(sides, _links_of(sides, texts))
                held.append((pair, times))
                offsets = pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (pair, times)]
                columns = [pa.array(np.full(len(texts), block)), pa.array(np.zeros(len(texts), bool)), batch.column(0).slice(at, len(texts)), *(pa.array(x) for x in figures.values()), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                seen += pc.sum(pc.binary_length(texts)).as_py() or 0
                if seen >= BLOCK_BYTES:
                    yield _block(block, held, id_kind)
                    block, held, seen = block + 1, [], 0
        if held:
            yield _block(block, held, id_kind)

    def _block(block: int, held: list, id_kind: pa.DataType) -> pa.RecordBatch:
        pair, at = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
        times = np.bincount(at, np.concatenate([t for _, t in held]), len(pair)).astype(np.int64)
        none = [pa.nulls(1, id_kind), *(pa.nulls(1, pa.int64()) for _ in range(4)), pa.nulls(1, pa.string())]
        return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([True]), *none, *(pa.array([x], pa.list_(pa.int32())) for x in (pair, times))], names=names)

    return slim.mapInArrow(run, f"block long, whole boolean, doc_id {kind}, {_FIGURES}, pairs array<int>, times array<int>")


def _links_of(sides: _Sides, texts: pa.Array) -> list[bytes]:
    """The links of each whole text; one that begins with white space is not cut, and an empty one has none."""
    texts = texts.cast(pa.string())
    apart = pc.match_substring_regex(texts, rf"\A[{_SPACE}]|\A\z").to_numpy(zero_copy_only=False)
    out = [b""] * len(texts)
    for k in np.flatnonzero(apart).tolist():
        if text := texts[k].as_py():
            out[k] = sides._links([text], 1)[0]
    rest = np.flatnonzero(~apart)
    for k, links in zip(rest.tolist(), sides.chunks(texts.take(pa.array(rest))), strict=True):
        out[k] = links
    return out


def pair_counts(rows: DataFrame, wide: int) -> DataFrame:
    """``pair``, ``count`` (links in the corpus) and ``best``: whether no other id is linked more often with the second side's."""
    counts = stage(rows.where("whole").select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum(F.col("p.times").cast("long")).alias("count")), "pair-counts")
    most = counts.groupBy((F.col("pair") % wide).alias("b")).agg(F.max("count").alias("most"))
    return counts.join(most, F.col("pair") % wide == F.col("b")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _scored(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """A block's documents with ``n_best`` and ``count_sum``."""
    pairs, order = docs.column("pairs").combine_chunks(), pc.sort_indices(counts, [("pair", "ascending")])
    known, count, best = (counts.column(c).take(order).to_numpy() for c in ("pair", "count", "best"))
    ends = np.cumsum(pc.list_value_length(pairs).to_numpy())
    flat, times = pairs.flatten().to_numpy(), docs.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
    at = np.searchsorted(known, flat)
    sums = [np.append(0, np.cumsum(times * x[at])) if len(flat) else np.zeros(1, np.int64) for x in (best.astype(np.int64), count)]
    n_best, count_sum = (s[ends] - s[np.append(0, ends[:-1])] for s in sums)
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return pa.table({**{c: docs.column(c) for c in kept}, "n_best": n_best, "count_sum": count_sum, "groups_sha256": docs.column("groups_sha256")})


def align_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """A row per document: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    Texts that are null or empty, or whose tokens of either side don't spell the text with a space before it, have no
    tokens: zeros and an empty string. Rows that repeat are documents of their own; an empty table gives an empty
    result; columns but ``doc_id`` and ``text`` are not read.
    """
    kind = dict(docs.dtypes)["doc_id"]
    wide = _sides(path_a or public_tokenizers.path(VOCABULARY_A), path_b or public_tokenizers.path(VOCABULARY_B)).wide
    rows = stage(linked_rows(docs, path_a, path_b), "links")
    counts = stage(pair_counts(rows, wide), "pair-best")
    asked = rows.where("whole").select(F.col("block").alias("of"), F.explode("pairs").alias("pair")).join(counts, "pair")
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.where("not whole").groupBy("block").cogroup(asked.groupBy("of")).applyInArrow(_scored, schema)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return align_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op11_token_alignment": op11_token_alignment}
SQL: dict[str, str] = {}
