"""Cached encoding of texts, one space-separated chunk at a time.

Byte-level BPE with the usual splitting pattern never joins what stands before a single space to the word after it,
if neither neighbour of the space is white space. A text can therefore be cut there, each chunk be encoded on its own
(with its space), and the ids be strung together. Words repeat, so most chunks come out of a bounded cache.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks that a worker keeps, about 80 bytes each; beyond, those that come again stay.
CACHE_CHUNKS = 600_000

#: White space of any kind that a tokenizer might know.
_SPACE = r"\t-\r \x1c-\x1f\x85\xa0  -     　"
_CUT = re.compile(rf"(?<=[^{_SPACE}]) (?=[^{_SPACE}])")
_BARRED = rf"\A[{_SPACE}]|[{_SPACE}]\z|\A\z"


def slices(texts: pa.Array, most: int) -> Iterator[tuple[int, pa.Array]]:
    """Runs of a string array of about ``most`` bytes, or one longer text, and where each starts."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        till = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, texts.slice(at, till - at)
        at = till


def _keys(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string of an array, made of its bytes at once; equal hashes do not prove equal strings."""
    n = len(words)
    ends = np.frombuffer(words.buffers()[1], np.int32, n + 1, words.offset * 4).astype(np.int64)
    if ends[-1] == ends[0]:
        return np.zeros(n, np.uint64)
    data = np.frombuffer(words.buffers()[2], np.uint8, ends[-1] - ends[0], ends[0]).astype(np.uint64)
    ends -= ends[0]
    sizes = np.diff(ends)
    powers = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64))
    sums = np.append(np.uint64(0), np.cumsum((data + np.uint64(1)) * powers[np.arange(ends[-1]) - np.repeat(ends[:-1], sizes)]))
    mixed = sums[ends[1:]] - sums[ends[:-1]]
    return mixed ^ mixed >> np.uint64(31)


class ChunkEncoder:
    """Encodes whole texts; ``encode`` gets a list of strings and how many of its first ones begin a text, and returns the ids of each.

    Ids are little-endian unsigned 32-bit bytes. The strings after the first ones begin with a single space and have no
    other white space at their ends, so that they may be encoded in a row. Known chunks are an Arrow array, found by a
    sorted array of their hashes and then compared; their ids lie one after the other in an array. A chunk is known by
    the text after the space in front of it. A size of -1 marks a chunk with white space at one of its ends, where the
    cut was not allowed: texts with such a chunk are cut anew with more care. Beyond ``size`` chunks those that only one
    slice of late had are forgotten, as most chunks never come again.
    """

    def __init__(self, encode: Callable[[list[str], int], list[bytes]], size: int = CACHE_CHUNKS):
        self.encode, self.size = encode, size
        self.words = pa.array([], pa.string())
        self.ids, self.begins, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.seen = np.zeros(0, np.int32)
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def __call__(self, texts: pa.Array) -> list[bytes]:
        """The ids of each whole text of an array of strings without nulls."""
        if not len(texts):
            return []
        cut = pc.split_pattern(texts.cast(pa.string()), " ")
        flat, starts = cut.flatten(), cut.offsets.to_numpy().astype(np.int64)
        coded = flat.dictionary_encode()
        words, index = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        heads = flat.take(pa.array(starts[:-1])).dictionary_encode()
        keys = _keys(words)
        at = self._find(words, keys)
        self.seen[at[at >= 0]] += 1
        unknown = np.flatnonzero(at < 0)
        new = words.take(pa.array(unknown))
        barred = pc.match_substring_regex(new, _BARRED).to_numpy(zero_copy_only=False)
        first = heads.dictionary.to_pylist()
        made = self.encode([*first, *pc.binary_join_element_wise("", new.filter(pa.array(~barred)), " ").to_pylist()], len(first))

        # The ids of the known chunks, the new ones and the texts' first ones, and where those of each chunk lie.
        head_sizes = np.array([len(x) >> 2 for x in made[: len(first)]])
        new_sizes = np.full(len(new), -1, np.int32)
        new_sizes[~barred] = [len(x) >> 2 for x in made[len(first) :]]
        at[unknown] = np.arange(len(self.words), len(self.words) + len(new))
        self._keep(new, keys[unknown], np.frombuffer(b"".join(made[len(first) :]), "<u4"), new_sizes)
        ids = np.concatenate([self.ids, np.frombuffer(b"".join(made[: len(first)]), "<u4")])
        begins = np.concatenate([self.begins[at], len(self.ids) + np.cumsum(head_sizes) - head_sizes])
        sizes = np.concatenate([self.sizes[at], head_sizes])
        index[starts[:-1]] = len(words) + heads.indices.to_numpy()
        each = sizes[index]
        careful = np.flatnonzero(np.minimum.reduceat(each, starts[:-1]) < 0).tolist()
        each = np.maximum(each, 0)
        ends = np.cumsum(each)
        data = ids[np.repeat(begins[index] - ends + each, each) + np.arange(ends[-1])].tobytes()
        till = (4 * ends[starts[1:] - 1]).tolist()
        out = [data[a:b] for a, b in zip([0, *till], till, strict=False)]
        for i in careful:
            out[i] = self._carefully(texts[i].as_py())
        if len(self.words) > self.size:
            self._forget()
        del cut, flat, coded, words, new, ids, data
        pa.default_memory_pool().release_unused()
        return out

    def _find(self, words: pa.Array, keys: np.ndarray) -> np.ndarray:
        """The place of each word among the known ones, or -1."""
        out = np.full(len(words), -1, np.int64)
        if len(self.keys):
            order = np.argsort(keys)
            at = np.empty(len(keys), np.int64)
            at[order] = np.minimum(np.searchsorted(self.keys, keys[order]), len(self.keys) - 1)
            like = np.flatnonzero(self.keys[at] == keys)
            slots = self.slots[at[like]].astype(np.int64)
            same = pc.equal(self.words.take(pa.array(slots)), words.take(pa.array(like))).to_numpy(zero_copy_only=False)
            out[like[same]] = slots[same]
        return out

    def _keep(self, words: pa.Array, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        filled = np.maximum(sizes, 0).astype(np.int64)
        slots = np.arange(len(self.words), len(self.words) + len(words), dtype=np.int32)
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys, self.slots = np.insert(self.keys, at, keys[order]), np.insert(self.slots, at, slots[order])
        self.words = pa.concat_arrays([self.words, words])
        self.begins = np.concatenate([self.begins, len(self.ids) + np.cumsum(filled) - filled])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.seen = np.concatenate([self.seen, np.ones(len(sizes), np.int32)])
        self.ids = np.concatenate([self.ids, ids])

    def _forget(self) -> None:
        """Keeps the chunks that most slices had, no more than half the bound."""
        least = 2
        while (self.seen >= least).sum() > self.size // 2:
            least += 1
        at = np.flatnonzero(self.seen >= least)
        words, begins, sizes, seen, ids = self.words.take(pa.array(at)), self.begins[at], self.sizes[at], self.seen[at] // 2, self.ids
        filled = np.maximum(sizes, 0).astype(np.int64)
        ends = np.cumsum(filled)
        kept = ids[np.repeat(begins - ends + filled, filled) + np.arange(ends[-1])] if len(ends) else ids[:0]
        self.words, self.ids, self.begins, self.sizes, self.seen = words, kept, ends - filled, sizes, seen
        keys = _keys(words)
        self.slots = np.argsort(keys).astype(np.int32)
        self.keys = keys[self.slots]

    def _carefully(self, text: str) -> bytes:
        head, *rest = _CUT.split(text)
        return b"".join(self.encode([head, *(" " + x for x in rest)], 1))
