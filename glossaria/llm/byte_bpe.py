"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Merges wait in buckets, one for each merge rank, that hold positions of a linked list of tokens. A bitmap over the
ranks, with summary levels above it, tells by find-first-set which rank comes next. A position whose pair has changed
since it was put down is stale and skipped. A merge costs the same however long the pre-token is, so pre-tokens of
millions of bytes are no problem.

Pre-tokens don't touch each other, so one queue may serve all new pre-tokens of a batch: of the next rank's bucket
the leftmost position of every pre-token is merged at once, as arrays. Very long pre-tokens and small batches go
position by position.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaria.llm.chunks import CACHE_CHUNKS, ChunkEncoder, slices
from glossaria.llm.common import bound_batches, id_and_text, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: From this many bytes on, a pre-token is merged on its own.
LONG_BYTES = 256
#: Batches of fewer bytes are merged position by position.
SMALL_BATCH = 100_000
#: Bytes of text that a worker holds the ids of.
BATCH_BYTES = 4 << 20


class RankQueue:
    """Which merge ranks have a bucket: bits in words of 64, a summary bit for each word that isn't zero, and so on up to one word."""

    def __init__(self, ranks: int):
        self.levels = []
        while True:
            ranks = (ranks + 63) >> 6
            self.levels.append([0] * ranks)
            if ranks <= 1:
                break

    def add(self, rank: int) -> None:
        for level in self.levels:
            word, bit = rank >> 6, 1 << (rank & 63)
            was = level[word]
            level[word] = was | bit
            if was:
                return
            rank = word

    def remove(self, rank: int) -> None:
        for level in self.levels:
            word = rank >> 6
            level[word] &= ~(1 << (rank & 63))
            if level[word]:
                return
            rank = word

    def first(self) -> int:
        """The lowest rank, or -1."""
        at = 0
        for level in reversed(self.levels):
            word = level[at]
            if not word:
                return -1
            at = at << 6 | ((word & -word).bit_length() - 1)
        return at


class Bpe:
    """The merges of one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.size = max(ranks.values()) + 1
        self.spelled: list[bytes] = [b""] * self.size
        for token, rank in ranks.items():
            self.spelled[rank] = token
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.pairs = {ranks[t[:k]] << 32 | ranks[t[k:]]: r for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        self.keys = np.fromiter(sorted(self.pairs), np.int64, len(self.pairs))
        self.values = np.array([self.pairs[k] for k in self.keys.tolist()], np.int64)

    def merge_one(self, data: bytes) -> list[int]:
        """The ids of a pre-token, position by position."""
        n, pairs = len(data), self.pairs
        token = self.of_byte[np.frombuffer(data, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n))
        buckets: dict[int, list[int]] = {}
        queue = RankQueue(self.size)

        def put(i: int) -> None:
            rank = pairs.get(token[i] << 32 | token[after[i]])
            if rank is None:
                return
            if rank in buckets:
                heapq.heappush(buckets[rank], i)
            else:
                buckets[rank] = [i]
                queue.add(rank)

        for i in range(n - 1):
            put(i)
        while (rank := queue.first()) >= 0:
            i = heapq.heappop(buckets[rank])
            if not buckets[rank]:
                del buckets[rank]
                queue.remove(rank)
            j = after[i]
            if token[i] < 0 or j >= n or pairs.get(token[i] << 32 | token[j]) != rank:
                continue  # stale
            token[i], token[j] = rank, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                put(i)
            if before[i] >= 0:
                put(before[i])
        return [t for t in token if t >= 0]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair, or -1."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (right >= 0), self.values[at], -1)

    def merge_many(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each of many pre-tokens, none of them empty."""
        sizes = np.array([len(p) for p in pieces])
        n, ends = int(sizes.sum()), np.cumsum(sizes)
        owner = np.repeat(np.arange(len(pieces)), sizes)
        token = np.append(self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)], -1)  # place n: the end of each list
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1] = n
        before[ends - sizes] = n
        rank_at = np.append(self._rank(token[:n], token[after[:n]]), -1)
        queue = RankQueue(self.size)
        buckets: dict[int, list[int]] = {}

        def put(ranks: np.ndarray, places: np.ndarray) -> None:
            for rank, place in zip(ranks.tolist(), places.tolist(), strict=True):
                if rank in buckets:
                    buckets[rank].append(place)
                else:
                    buckets[rank] = [place]
                    queue.add(rank)

        start = np.flatnonzero(rank_at >= 0)
        if len(start):
            put(rank_at[start], start)
        while (rank := queue.first()) >= 0:
            at = np.array(buckets[rank])
            at = np.unique(at[rank_at[at] == rank])  # the others are stale
            own = owner[at]
            leftmost = np.append(True, own[1:] != own[:-1]) if len(at) else np.zeros(0, bool)
            if leftmost.all():
                del buckets[rank]
                queue.remove(rank)
            else:
                buckets[rank] = at[~leftmost].tolist()
            at = at[leftmost]
            if not len(at):
                continue
            gone = after[at]
            rest = after[gone]
            token[at], token[gone] = rank, -1
            after[at] = rest
            before[rest] = at
            rank_at[gone] = -1
            left = before[at]
            left = left[left < n]
            places = np.concatenate([at, left])
            ranks = self._rank(token[places], token[after[places]])
            rank_at[places] = ranks
            new = ranks >= 0
            if new.any():
                put(ranks[new], places[new])
        alive = token[:n] >= 0
        counts = np.add.reduceat(alive, ends - sizes)
        return np.split(token[:n][alive], np.cumsum(counts)[:-1])

    def encode_pretokens(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of pre-tokens as little-endian unsigned 32-bit bytes; a pre-token in the vocabulary is its own id."""
        out: list[bytes] = [b""] * len(pieces)
        many = []
        for i, p in enumerate(pieces):
            if (rank := self.ranks.get(p)) is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(p) >= LONG_BYTES:
                out[i] = np.array(self.merge_one(p), "<u4").tobytes()
            elif p:
                many.append(i)
        if sum(len(pieces[i]) for i in many) < SMALL_BATCH:
            for i in many:
                out[i] = np.array(self.merge_one(pieces[i]), "<u4").tobytes()
        else:
            for i, ids in zip(many, self.merge_many([pieces[i] for i in many]), strict=True):
                out[i] = ids.astype("<u4").tobytes()
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.spelled.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class BpeEncoder:
    """Encodes batches of texts."""

    def __init__(self, bpe: Bpe, size: int = CACHE_CHUNKS):
        self.bpe = bpe
        self.chunks = ChunkEncoder(self._chunks, size)

    def _chunks(self, chunks: list[str], _heads: int = 0) -> list[bytes]:
        split = [self.bpe.pattern.findall(c) for c in chunks]
        new = list({p for s in split for p in s})
        known = dict(zip(new, self.bpe.encode_pretokens([p.encode() for p in new]), strict=True))
        return [b"".join(map(known.__getitem__, s)) if len(s) != 1 else known[s[0]] for s in split]

    def __call__(self, texts: list[str]) -> list[bytes]:
        return self.chunks(pa.array(texts, pa.string()))


@lru_cache(maxsize=2)
def load_bpe(path: str) -> Bpe:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
    return Bpe(ranks, public_tokenizers.PATTERN)


@lru_cache(maxsize=2)
def _encoder(path: str) -> BpeEncoder:
    return BpeEncoder(load_bpe(path))


def encode(text: Column, path: str | None = None) -> Column:
    """The ids of a whole text (null: empty) as binary, little-endian unsigned 32-bit. ``path``: the rank file on every executor."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(path or public_tokenizers.path(VOCABULARY))
        for texts in batches:
            yield pd.Series(encoder([t or "" for t in texts]), dtype=object)

    return run(text)


def decode(ids: Column, path: str | None = None) -> Column:
    """The bytes that the ids of :func:`encode` spell; null counts as no ids."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = load_bpe(path or public_tokenizers.path(VOCABULARY))
        for column in batches:
            yield pd.Series([bpe.decode(x or b"") for x in column], dtype=object)

    return run(ids)


def tokenize(docs: DataFrame, path: str | None = None, with_decoded: bool = False) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` of every document, one row each, and ``decoded``, the bytes its ids spell, if asked for.

    A null or empty text has no ids. Other columns are not read. Both ways run in one pass, ``BATCH_BYTES`` at a time.
    """
    slim = id_and_text(docs)
    names = ["doc_id", "n_tokens", "ids"] + ["decoded"] * with_decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path or public_tokenizers.path(VOCABULARY))
        for batch in batches:
            for at, texts in slices(batch.column(1), BATCH_BYTES):
                ids = encoder.chunks(texts)
                columns = [batch.column(0).slice(at, len(texts)), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                if with_decoded:
                    columns.append(pa.array([encoder.bpe.decode(x) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return slim.mapInArrow(run, f"doc_id {dict(slim.dtypes)['doc_id']}, n_tokens long, ids binary" + ", decoded binary" * with_decoded)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    found = tokenize(table(spark, sf_dir, "documents"), with_decoded=True)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op8_byte_bpe": op8_byte_bpe}
SQL: dict[str, str] = {}
