"""Media columns in lossless WebP (RFC 9649).

The reader handles the whole lossless format: simple and coded prefix codes, groups of prefix codes by tile,
back-references, the colour cache, and the predictor, cross-colour, subtract-green and palette transforms. Runs of
literal pixels, the bulk of most streams, are read as arrays: for every bit it is looked up which pixel would start
there and where it would end, and the actual pixels are then the chain of ends from the first bit on.

The writer stores byte strings as 8-bit samples: green of pixels without red and blue, in rows of ``ROW``
samples, an image for every ``ROW * 16384`` bytes. It uses prefix codes, back-references for lines and zeros that
repeat, and a palette where a payload has few different bytes.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossaria.llm.chunks import slices
from glossaria.llm.common import bound_batches, id_and_text, table

#: Bytes of text that a worker holds the media of.
BATCH_BYTES = 4 << 20
ROW = 64
MOST_ROWS = 1 << 14
#: Repeats shorter than this many samples are written out.
LEAST_REPEAT, MOST_REPEAT = 12, 4096
#: The farthest distance that the format's codes reach; 120 numbers stand for neighbours.
MOST_DISTANCE = (1 << 20) - 120
#: Bits that are looked up at once.
_SPAN = 1 << 18
#: Pixels that are jumped over at once in following a chain.
_JUMP = 16

# Fixed values of the format.
CODE_LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
LENGTH_CODES, DISTANCE_CODES, MOST_BITS = 24, 40, 15
CACHE_FACTOR = 0x1E35A7BD
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)

#: Distances 1 to 120 name pixels close by (to the left, above), nearest first.
NEIGHBOURS = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), -p[0]))


class WebpError(ValueError):
    """The bytes are no lossless WebP image."""


# ---------------------------------------------------------------- prefix codes


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each symbol with a length, first bit lowest."""
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    by_length = lengths[order].astype(np.int64)
    # Codes of one length follow each other; as numbers of 15 bits each starts where the one before ends.
    ends = np.cumsum(1 << (MOST_BITS - by_length))
    starts = np.append(0, ends[:-1])
    codes = np.zeros(len(lengths), np.int64)
    codes[order] = _REVERSED[starts]
    return codes


def _reverse_table() -> np.ndarray:
    x, out = np.arange(1 << MOST_BITS), np.zeros(1 << MOST_BITS, np.int64)
    for _ in range(MOST_BITS):
        out, x = out << 1 | x & 1, x >> 1
    return out


_REVERSED = _reverse_table()


class Code:
    """A prefix code to read with: ``symbol`` and ``bits`` by the next ``depth`` bits."""

    def __init__(self, lengths: np.ndarray):
        used = np.flatnonzero(lengths)
        if not len(used):
            raise WebpError("a prefix code has no symbol")
        if len(used) == 1:  # nothing to tell apart: no bits
            self.depth, self.symbol, self.bits = 0, np.array([used[0]], np.int32), np.zeros(1, np.int32)
        else:
            by_length = lengths[used].astype(np.int64)
            if (1 << (MOST_BITS - by_length)).sum() != 1 << MOST_BITS:
                raise WebpError("a prefix code is not complete")
            self.depth = int(by_length.max())
            order = used[np.argsort(by_length, kind="stable")]
            times = 1 << (self.depth - lengths[order].astype(np.int64))
            at = _REVERSED[np.arange(1 << self.depth)] >> (MOST_BITS - self.depth)
            self.symbol = np.repeat(order, times).astype(np.int32)[at]
            self.bits = np.repeat(lengths[order], times).astype(np.int32)[at]
        self.mask = (1 << self.depth) - 1
        self.symbols, self.lens = None, None

    def read(self, bits: Bits) -> int:
        if self.symbols is None:
            self.symbols, self.lens = self.symbol.tolist(), self.bits.tolist()
        at = bits.peek() & self.mask
        bits.at += self.lens[at]
        return self.symbols[at]


class Bits:
    """Reads numbers, lowest bit first. Bits after the end are zero, up to a bound that tells that the stream is cut off."""

    def __init__(self, data: bytes):
        self.size = 8 * len(data)
        self.data = data + bytes(16)
        self.at = 0

    def peek(self) -> int:
        byte = self.at >> 3
        return int.from_bytes(self.data[byte : byte + 8], "little") >> (self.at & 7)

    def read(self, n: int) -> int:
        value = self.peek() & ((1 << n) - 1)
        self.at += n
        if self.at > self.size:
            raise WebpError("the stream ends too early")
        return value


def read_code(bits: Bits, alphabet: int) -> Code:
    lengths = np.zeros(alphabet, np.int32)
    if bits.read(1):
        two, wide = bits.read(1), bits.read(1)
        first = bits.read(8 if wide else 1)
        lengths[first] = 1
        if two:
            lengths[bits.read(8)] = 1
        return Code(lengths)
    of_lengths = np.zeros(19, np.int32)
    for k in range(4 + bits.read(4)):
        of_lengths[CODE_LENGTH_ORDER[k]] = bits.read(3)
    tokens = alphabet
    if bits.read(1):
        tokens = 2 + bits.read(2 + 2 * bits.read(3))
    code, out, last = Code(of_lengths), [], 8
    while len(out) < alphabet and tokens:
        tokens -= 1
        s = code.read(bits)
        if s < 16:
            out.append(s)
            last = s or last
        elif s == 16:
            out += [last] * (3 + bits.read(2))
        elif s == 17:
            out += [0] * (3 + bits.read(3))
        else:
            out += [0] * (11 + bits.read(7))
    if len(out) > alphabet or bits.at > bits.size:
        raise WebpError("code lengths run over")
    lengths[: len(out)] = out
    return Code(lengths)


# ---------------------------------------------------------------- pixels


def _extra(bits: Bits, symbol: int) -> int:
    """The length or distance that a prefix and its extra bits stand for."""
    if symbol < 4:
        return symbol + 1
    n = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << n) + bits.read(n) + 1


def _slots(pixels, cache_bits: int):
    return ((pixels.astype(np.uint64) * CACHE_FACTOR) & 0xFFFFFFFF) >> np.uint64(32 - cache_bits)


class _Literals:
    """Runs of literal pixels under one group of codes."""

    def __init__(self, bits: Bits, group: list[Code]):
        self.bits, self.group = bits, group
        self.base = self.stop = 0
        self.free = not any(c.depth for c in group[:4])  # pixels without bits, all alike

    def _look(self, at: int) -> None:
        """For each bit from ``at`` on: the symbols that a pixel would have there, and the bits after it and after ``_JUMP`` pixels."""
        first = at >> 3
        part = np.frombuffer(self.bits.data[first : first + (_SPAN >> 3) + 16], np.uint8).astype(np.int32)
        words = part[:-2] | part[1:-1] << 8 | part[2:] << 16
        self.window = window = (words[:, None] >> np.arange(8, dtype=np.int32)).ravel()
        # A place that no literal follows leads to the end. The last bits are looked at anew from a later base.
        self.base, self.total = first * 8, len(window)
        self.stop = self.total - 64
        green = self.group[0]
        here = window & green.mask
        self.green = green.symbol[here]
        after = np.arange(self.total + 1, dtype=np.int32)
        after[:-1] += green.bits[here]
        self.steps = []
        for code in self.group[1:4]:
            self.steps.append(None)
            if code.depth:
                np.minimum(after, self.total - 1, out=after)
                self.steps[-1] = after
                after = after + code.bits[window[after] & code.mask]
        after[:-1][self.green >= 256] = self.total
        np.minimum(after, self.total, out=after)
        after[-1] = self.total
        self.levels = [after]
        for _ in range(_JUMP.bit_length() - 1):
            self.levels.append(self.levels[-1][self.levels[-1]])
        self.one, self.far = memoryview(after), memoryview(self.levels[-1])

    def _chain(self, at: int, most: int) -> tuple[np.ndarray, int]:
        """Where up to ``most`` literals from ``at`` on start, and the bit after them."""
        far, one, total, stop = self.far, self.one, self.total, self.stop
        jumps, left = [], most
        while left >= _JUMP and (after := far[at]) < total:
            jumps.append(at)
            at = after
            left -= _JUMP
        places = np.array(jumps, np.int32)
        for level in self.levels[-2::-1]:  # each place and the one half-way to the next
            places = np.column_stack([places, level[places]]).ravel()
        rest = []
        while at < stop and left and (after := one[at]) < total:
            rest.append(at)
            at = after
            left -= 1
        return (np.concatenate([places, np.array(rest, np.int32)]) if rest else places), at

    def read(self, most: int) -> np.ndarray:
        """Up to ``most`` literal pixels from here on; stops before anything else."""
        bits, group, found, got = self.bits, self.group, [], 0
        if self.free:
            g, r, b, a = (int(c.symbol[0]) for c in group[:4])
            return np.full(0 if g >= 256 else most, a << 24 | r << 16 | g << 8 | b, np.uint32)
        while got < most:
            if not 0 <= bits.at - self.base < self.stop:
                self._look(bits.at)
            places, at = self._chain(bits.at - self.base, most - got)
            got += len(places)
            value = self.green[places].astype(np.uint32) << 8
            for code, step, shift in zip(group[1:4], self.steps, (16, 0, 24), strict=True):
                channel = np.uint32(code.symbol[0]) if step is None else code.symbol[self.window[step[places]] & code.mask].astype(np.uint32)
                value |= channel << np.uint32(shift)
            found.append(value)
            bits.at = self.base + at
            if bits.at > bits.size:
                raise WebpError("the stream ends too early")
            if at < self.stop:
                break  # enough, or no literal stands here
        return found[0] if len(found) == 1 else np.concatenate(found) if found else np.zeros(0, np.uint32)


def read_image(bits: Bits, width: int, height: int, main: bool = False) -> np.ndarray:
    """An entropy-coded image as ``height`` rows of ARGB; the main one may have groups of codes by tile."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    if cache_bits > 11:
        raise WebpError("the colour cache is too large")
    tiles, tile_bits = None, 0
    if main and bits.read(1):
        tile_bits = bits.read(3) + 2
        tiles = (read_image(bits, -(-width >> tile_bits), -(-height >> tile_bits)) >> 8 & 0xFFFF).astype(np.int64)
    sizes = (256 + LENGTH_CODES + (1 << cache_bits if cache_bits else 0), 256, 256, 256, DISTANCE_CODES)
    groups = [[read_code(bits, n) for n in sizes] for _ in range(int(tiles.max()) + 1 if tiles is not None else 1)]
    total = width * height
    out = np.zeros(total, np.uint32)
    cache = np.zeros(1 << cache_bits, np.uint32) if cache_bits else None
    runs = [_Literals(bits, g) for g in groups]
    at = cached = 0
    while at < total:
        if tiles is None:
            k, most = 0, total - at
        else:  # literals up to the tile's edge
            x, y = at % width, at // width
            k = int(tiles[y >> tile_bits, x >> tile_bits])
            most = min(width, (x >> tile_bits) + 1 << tile_bits) - x
        group = groups[k]
        part = runs[k].read(most)
        out[at : at + len(part)] = part
        at += len(part)
        if len(part) == most:
            continue
        symbol = group[0].read(bits)
        if symbol < 256:
            raise WebpError("the stream ends too early")
        if symbol < 256 + LENGTH_CODES:
            n = _extra(bits, symbol - 256)
            d = _extra(bits, group[4].read(bits))
            if d > 120:
                d -= 120
            else:
                dx, dy = NEIGHBOURS[d - 1]
                d = max(1, dx + dy * width)
            if d > at or at + n > total:
                raise WebpError("a back-reference leaves the image")
            while n:
                m = min(n, d)
                out[at : at + m] = out[at - d : at - d + m]
                at, n, d = at + m, n - m, d + m if n > m else d
        else:
            if cache is None:
                raise WebpError("no colour cache")
            new = out[cached:at]
            cache[_slots(new, cache_bits)] = new  # of equal slots the last stays
            out[at] = cache[symbol - 256 - LENGTH_CODES]
            cached, at = at, at + 1
        if bits.at > bits.size:
            raise WebpError("the stream ends too early")
    return out.reshape(height, width)


# ---------------------------------------------------------------- transforms


def channels(pixels: np.ndarray) -> np.ndarray:
    """ARGB numbers as an array with a last axis of blue, green, red, alpha."""
    return np.ascontiguousarray(pixels.astype("<u4")).view(np.uint8).reshape(*pixels.shape, 4)


def numbers(parts: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(parts.astype(np.uint8)).view("<u4").reshape(parts.shape[:-1]).astype(np.uint32)


def predict(mode: int, left, top, top_right, top_left):
    """The prediction of a mode from neighbours as arrays of signed channels."""
    half = lambda a, b: (a + b) >> 1
    if mode == 1:
        return left
    if mode == 2:
        return top
    if mode == 3:
        return top_right
    if mode == 4:
        return top_left
    if mode == 5:
        return half(half(left, top_right), top)
    if mode == 6:
        return half(left, top_left)
    if mode == 7:
        return half(left, top)
    if mode == 8:
        return half(top_left, top)
    if mode == 9:
        return half(top, top_right)
    if mode == 10:
        return half(half(left, top_left), half(top, top_right))
    if mode == 11:
        # How far left + top - top_left lies from left is |top - top_left|, and the other way round.
        far_left, far_top = np.abs(top - top_left).sum(-1, keepdims=True), np.abs(left - top_left).sum(-1, keepdims=True)
        return np.where(far_left < far_top, left, top)
    if mode == 12:
        return np.clip(left + top - top_left, 0, 255)
    if mode == 13:
        mean = half(left, top)
        return np.clip(mean + np.trunc((mean - top_left) / 2).astype(mean.dtype), 0, 255)
    black = np.zeros_like(top)
    black[..., 3] = 255
    return black


def invert_predictor(pixels: np.ndarray, modes: np.ndarray, tile_bits: int) -> np.ndarray:
    """Adds each pixel's prediction; rows from the top, along a row at once where the mode doesn't look to the left."""
    rest = channels(pixels).astype(np.int32)
    height, width = pixels.shape
    out = np.zeros_like(rest)
    black = np.array([0, 0, 0, 255])
    out[0] = np.cumsum(np.concatenate([(rest[0, :1] + black), rest[0, 1:]]), axis=0) & 255
    for y in range(1, height):
        above = out[y - 1]
        out[y, 0] = (rest[y, 0] + above[0]) & 255
        beyond = np.concatenate([above[1:], out[y, :1]])  # right of the last pixel above stands the first of this row
        x = 1
        while x < width:
            mode = int(modes[y >> tile_bits, x >> tile_bits])
            till = min(width, (x >> tile_bits) + 1 << tile_bits)
            if mode == 1:
                out[y, x:till] = (np.cumsum(rest[y, x:till], axis=0) + out[y, x - 1]) & 255
            elif mode in (5, 6, 7, 10, 11, 12, 13):
                for k in range(x, till):
                    out[y, k] = (rest[y, k] + predict(mode, out[y, k - 1], above[k], beyond[k], above[k - 1])) & 255
            else:
                out[y, x:till] = (rest[y, x:till] + predict(mode, None, above[x:till], beyond[x:till], above[x - 1 : till - 1])) & 255
            x = till
    return numbers(out)


def _by_tile(values: np.ndarray, tile_bits: int, shape: tuple[int, int]) -> np.ndarray:
    return np.repeat(np.repeat(values, 1 << tile_bits, 0)[: shape[0]], 1 << tile_bits, 1)[:, : shape[1]]


def colour_delta(factor: np.ndarray, colour: np.ndarray) -> np.ndarray:
    return factor.astype(np.int8).astype(np.int32) * colour.astype(np.uint8).view(np.int8).astype(np.int32) >> 5


def invert_cross_colour(pixels: np.ndarray, factors: np.ndarray, tile_bits: int) -> np.ndarray:
    parts = channels(pixels).astype(np.int32)
    f = _by_tile(channels(factors), tile_bits, pixels.shape)
    green = parts[..., 1]
    red = (parts[..., 2] + colour_delta(f[..., 0].view(np.int8), green)) & 255
    blue = (parts[..., 0] + colour_delta(f[..., 1].view(np.int8), green) + colour_delta(f[..., 2].view(np.int8), red)) & 255
    parts[..., 2], parts[..., 0] = red, blue
    return numbers(parts)


def invert_palette(pixels: np.ndarray, colours: np.ndarray, width: int) -> np.ndarray:
    """Each green holds one index or, with few colours, several, the leftmost in the lowest bits."""
    pack = _pack_bits(len(colours))
    index = pixels >> 8 & 255
    if pack:
        each = 8 >> pack
        shifts = (np.arange(1 << pack) * each).astype(np.uint32)
        index = (index[:, :, None] >> shifts & ((1 << each) - 1)).reshape(len(pixels), -1)[:, :width]
    return np.concatenate([colours, np.zeros(256, np.uint32)])[index]


def _pack_bits(colours: int) -> int:
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


def decode_stream(data: bytes) -> np.ndarray:
    """The pixels of a VP8L chunk as rows of ARGB."""
    bits = Bits(data)
    if bits.read(8) != 0x2F:
        raise WebpError("no signature")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise WebpError("unknown version")
    full, undo, seen = width, [], set()
    while bits.read(1):
        kind = bits.read(2)
        if kind in seen:
            raise WebpError("a transform comes twice")
        seen.add(kind)
        if kind in (PREDICTOR, CROSS_COLOUR):
            tile_bits = bits.read(3) + 2
            tiles = read_image(bits, -(-width >> tile_bits), -(-height >> tile_bits))
            undo.append((kind, tiles, tile_bits, width))
        elif kind == PALETTE:
            n = bits.read(8) + 1
            colours = numbers(np.cumsum(channels(read_image(bits, n, 1))[0].astype(np.int64), axis=0) & 255)
            undo.append((kind, colours, 0, width))
            width = -(-width >> _pack_bits(n))
        else:
            undo.append((kind, None, 0, width))
    pixels = read_image(bits, width, height, main=True)
    for kind, what, tile_bits, before in reversed(undo):
        if kind == PREDICTOR:
            pixels = invert_predictor(pixels, what >> 8 & 15, tile_bits)
        elif kind == CROSS_COLOUR:
            pixels = invert_cross_colour(pixels, what, tile_bits)
        elif kind == PALETTE:
            pixels = invert_palette(pixels, what, before)
        else:
            parts = channels(pixels)
            parts[..., (0, 2)] += parts[..., 1:2]
            pixels = numbers(parts)
    assert pixels.shape[1] == full
    return pixels


def _streams(body: bytes) -> Iterator[bytes]:
    """The lossless streams among a file's chunks, those in frames of animations too; profiles and other data are passed over."""
    at = 0
    while at + 8 <= len(body):
        kind, size = body[at : at + 4], int.from_bytes(body[at + 4 : at + 8], "little")
        inside = body[at + 8 : at + 8 + size]
        if len(inside) < size:
            raise WebpError("the file ends too early")
        if kind == b"VP8L":
            yield inside
        elif kind == b"ANMF":
            yield from _streams(inside[16:])
        at += 8 + size + (size & 1)


def images(data: bytes) -> Iterator[np.ndarray]:
    """The pixels of each lossless image of the WebP files that stand one after the other in ``data``, in simple or extended containers."""
    at = 0
    while at < len(data):
        if data[at : at + 4] != b"RIFF" or data[at + 8 : at + 12] != b"WEBP":
            raise WebpError("no WebP file")
        till = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
        if till > len(data):
            raise WebpError("the file ends too early")
        found = list(_streams(data[at + 12 : till]))
        if not found:
            raise WebpError("no lossless image in the file")
        for stream in found:
            yield decode_stream(stream)
        at = till


# ---------------------------------------------------------------- writing


def code_lengths(counts: np.ndarray, most: int = MOST_BITS) -> np.ndarray:
    """Lengths of a prefix code for ``counts``, none over ``most`` bits."""
    lengths = np.zeros(len(counts), np.int32)
    used = np.flatnonzero(counts).tolist()
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    weights, least = counts[used].tolist(), 1
    while True:
        n = len(used)
        heap = sorted((w if w > least else least, k) for k, w in enumerate(weights))
        parent = [0] * (2 * n - 1)
        for k in range(n, 2 * n - 1):
            a = heapq.heappop(heap)
            b = heap[0]
            parent[a[1]] = parent[b[1]] = k
            heapq.heapreplace(heap, (a[0] + b[0], k))
        depth = [0] * (2 * n - 1)
        for k in range(2 * n - 3, -1, -1):
            depth[k] = depth[parent[k]] + 1
        if max(depth[:n]) <= most:
            lengths[used] = depth[:n]
            return lengths
        least *= 4  # flattens the rare ones


class Writer:
    """Collects numbers and their bits, lowest bit first."""

    def __init__(self):
        self.values, self.sizes, self.fields = [], [], []

    def put(self, value: int, n: int) -> None:
        self.fields.append((value, n))

    def put_list(self, fields: list[tuple[int, int]]) -> None:
        self.fields += fields

    def put_all(self, values: np.ndarray, sizes: np.ndarray) -> None:
        if self.fields:
            pairs = np.array(self.fields, np.int64)
            self.values.append(pairs[:, 0])
            self.sizes.append(pairs[:, 1])
            self.fields = []
        self.values.append(values)
        self.sizes.append(sizes)

    def bytes(self) -> bytes:
        self.put_all(np.zeros(0, np.int64), np.zeros(0, np.int64))
        values, sizes = np.concatenate(self.values).astype(np.uint64), np.concatenate(self.sizes)
        ends = np.cumsum(sizes)
        total = int(ends[-1])
        starts = ends - sizes
        word = starts >> 5
        placed = values << (starts & 31).astype(np.uint64)  # at most 31 + 32 bits
        cuts = np.flatnonzero(np.diff(word, prepend=-1))
        sums = np.zeros((total >> 5) + 3, np.uint64)
        sums[word[cuts]] = np.add.reduceat(placed, cuts)  # fields don't overlap, so their sum is their union
        out = sums & np.uint64(0xFFFFFFFF)
        out[1:] += sums[:-1] >> np.uint64(32)
        return out.astype("<u4").tobytes()[: -(-total // 8)]

    def code(self, lengths: np.ndarray) -> np.ndarray:
        """Writes a prefix code and returns the lengths to write with: none for a lone symbol."""
        used = np.flatnonzero(lengths)
        if len(used) <= 2 and (not len(used) or used.max() < 256):
            first, more = (int(used[0]) if len(used) else 0), used[1:].tolist()
            wide = int(first > 1)
            self.put_list([(1, 1), (len(more), 1), (wide, 1), (first, 8 if wide else 1)] + [(m, 8) for m in more])
        else:
            self._coded(lengths, int(used[-1]) + 1)
        return np.zeros_like(lengths) if len(used) < 2 else lengths

    def _coded(self, lengths: np.ndarray, n: int) -> None:
        cuts = np.flatnonzero(np.diff(lengths[:n])) + 1
        tokens: list[tuple[int, int, int]] = []  # symbol, extra, its bits
        last = 8
        for at, till in zip([0, *cuts.tolist()], [*cuts.tolist(), n], strict=True):
            value, times = int(lengths[at]), till - at
            if value and value != last:
                tokens.append((value, 0, 0))
                last, times = value, times - 1
            while times:
                if value and times >= 3:
                    k = min(times, 6)
                    tokens.append((16, k - 3, 2))
                elif not value and times >= 11:
                    k = min(times, 138)
                    tokens.append((18, k - 11, 7))
                elif not value and times >= 3:
                    k = min(times, 10)
                    tokens.append((17, k - 3, 3))
                else:
                    k = 1
                    tokens.append((value, 0, 0))
                times -= k
        if len(tokens) < 2:
            tokens.append((0, 0, 0))  # the format counts two at least
        of = code_lengths(np.bincount([t[0] for t in tokens], minlength=19), 7)
        codes = canonical(of).tolist()
        sizes = of.tolist() if (of > 0).sum() > 1 else [0] * 19
        in_order = [int(of[k]) for k in CODE_LENGTH_ORDER]
        while len(in_order) > 4 and not in_order[-1]:
            in_order.pop()
        width = max(2, (len(tokens) - 2).bit_length() + 1 & ~1)
        fields = [(0, 1), (len(in_order) - 4, 4), *((k, 3) for k in in_order), (1, 1), ((width - 2) // 2, 3), (len(tokens) - 2, width)]
        for symbol, extra, bits in tokens:
            fields.append((codes[symbol], sizes[symbol]))
            if bits:
                fields.append((extra, bits))
        self.put_list(fields)


def prefix(value: int) -> tuple[int, int, int]:
    """The prefix, extra number and its bits of a length or distance."""
    if value <= 4:
        return value - 1, 0, 0
    n = (value - 1).bit_length() - 2
    symbol = 2 * n + 2 + (value - 1 >> n & 1)
    return symbol, (value - 1) & ((1 << n) - 1), n


def put_pixels(writer: Writer, pixels: np.ndarray, repeats: list[tuple[int, int, int]] = (), cache_bits: int = 0, main: bool = True) -> None:
    """An entropy-coded image of ARGB numbers. ``repeats``: place, length, distance of what is copied, in order, apart."""
    flat = pixels.ravel()
    writer.put_list([(1, 1), (cache_bits, 4)] if cache_bits else [(0, 1)])
    if main:
        writer.put(0, 1)
    n = len(flat)
    literal = np.ones(n, bool)
    for at, length, _ in repeats:
        literal[at : at + length] = False
    parts = channels(flat)
    streams = [parts[:, k].astype(np.int64) for k in (1, 2, 0, 3)]
    hits = np.zeros(n, bool)
    if cache_bits:
        slots, cache = _slots(flat, cache_bits).astype(np.int64), {}
        for k, (slot, p) in enumerate(zip(slots.tolist(), flat.tolist(), strict=True)):
            hits[k] = literal[k] and cache.get(slot, 0 if slot not in cache else None) == p
            cache[slot] = p
        streams[0] = np.where(hits, 256 + LENGTH_CODES + slots, streams[0])
    alphabet = 256 + LENGTH_CODES + (1 << cache_bits if cache_bits else 0)
    copies = [(at, prefix(length), prefix(distance + 120)) for at, length, distance in repeats]
    places = np.flatnonzero(literal) if copies else np.arange(n)
    counts = [np.bincount(streams[0][places], minlength=alphabet)]
    for k in (1, 2, 3):
        alike = not copies and not cache_bits and (streams[k] == streams[k][0]).all()
        counts.append(np.bincount(streams[k][:1] if alike else streams[k][literal & ~hits], minlength=256))
    far = np.zeros(DISTANCE_CODES, np.int64)
    for _, length, distance in copies:
        counts[0][256 + length[0]] += 1
        far[distance[0]] += 1

    # Up to four fields for a pixel, or for a copy's first one; those of no bits are left out.
    order, values, widths = [], [], []
    for k, count in enumerate((*counts, far)):
        lengths = code_lengths(count)
        sizes = writer.code(lengths)
        if k < 4 and sizes.any():
            codes, here = canonical(lengths), places if k == 0 or not cache_bits else places[~hits[places]]
            order.append(here * 4 + k)
            values.append(codes[streams[k][here]])
            widths.append(sizes[streams[k][here]])
        if copies and k in (0, 4):
            codes = canonical(lengths)
            for at, (ls, lx, ln), (ds, dx, dn) in copies:
                s, x, m = (256 + ls, lx, ln) if k == 0 else (ds, dx, dn)
                order.append(np.array([at * 4 + k // 2, at * 4 + k // 2 + 1]))
                values.append(np.array([codes[s], x]))
                widths.append(np.array([sizes[s], m]))
    if len(order) == 1:
        writer.put_all(values[0], widths[0])
    elif order:
        by = np.argsort(np.concatenate(order), kind="stable")
        values, widths = np.concatenate(values)[by], np.concatenate(widths)[by]
        writer.put_all(values[widths > 0], widths[widths > 0])


def header(writer: Writer, width: int, height: int) -> None:
    writer.put_list([(0x2F, 8), (width - 1, 14), (height - 1, 14), (0, 1), (0, 3)])


def file_of(stream: bytes) -> bytes:
    body = b"WEBPVP8L" + len(stream).to_bytes(4, "little") + stream + bytes(len(stream) & 1)
    return b"RIFF" + len(body).to_bytes(4, "little") + body


def _repeats(block: bytes) -> list[tuple[int, int, int]]:
    """Lines that stood before, and the zeros at the end, as place, length and distance."""
    found, seen, at = [], {}, 0
    text = block.rstrip(b"\0")
    for line in text.split(b"\n"):
        n = len(line) + 1
        if n >= LEAST_REPEAT and at + n <= len(block):
            key = block[at : at + n]
            before = seen.get(key)
            if before is None or at - before > MOST_DISTANCE:
                seen[key] = at
            else:
                found += [(at + k, min(MOST_REPEAT, n - k), at - before) for k in range(0, n, MOST_REPEAT)]
        at += n
    last = found[-1][0] + found[-1][1] if found else 0
    zeros = max(len(text) + 1, last + 1)
    if len(block) - zeros >= LEAST_REPEAT:
        found += [(k, min(MOST_REPEAT, len(block) - k), 1) for k in range(zeros, len(block), MOST_REPEAT)]
    return found


def store_bytes(payload: bytes) -> bytes:
    """Payload bytes (a positive multiple of ``ROW``) as lossless WebP files."""
    out = []
    for start in range(0, len(payload), ROW * MOST_ROWS):
        block = payload[start : start + ROW * MOST_ROWS]
        samples = np.frombuffer(block, np.uint8)
        rows = len(samples) // ROW
        writer = Writer()
        header(writer, ROW, rows)
        different = np.flatnonzero(np.bincount(samples, minlength=256))
        if len(different) <= 16:
            colours = different.astype(np.uint32) << 8 | 0xFF000000
            steps = numbers((channels(colours).astype(np.int64) - np.concatenate([np.zeros((1, 4), np.int64), channels(colours)[:-1].astype(np.int64)])) & 255)
            writer.put_list([(1, 1), (PALETTE, 2), (len(different) - 1, 8)])
            put_pixels(writer, steps, main=False)
            pack = _pack_bits(len(different))
            index = np.searchsorted(different, samples).reshape(rows, ROW >> pack, 1 << pack)
            green = (index << np.arange(1 << pack) * (8 >> pack)).sum(2)
            writer.put(0, 1)
            put_pixels(writer, green.astype(np.uint32) << 8 | np.uint32(0xFF000000))
        else:
            writer.put(0, 1)
            put_pixels(writer, samples.astype(np.uint32) << 8 | np.uint32(0xFF000000), _repeats(block))
        out.append(file_of(writer.bytes()))
    return b"".join(out)


def load_bytes(media: bytes) -> bytes:
    """The samples of :func:`store_bytes`: green of every pixel."""
    return b"".join((pixels >> 8 & 255).astype(np.uint8).tobytes() for pixels in images(media))


def padded(text: str | None) -> bytes:
    """UTF-8 and zeros up to a positive multiple of ``ROW``."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(-len(raw) % ROW or (0 if raw else ROW))


# ---------------------------------------------------------------- columns


@F.pandas_udf(T.BinaryType())
def _store(texts: pd.Series) -> pd.Series:
    return pd.Series([store_bytes(padded(t)) for t in texts], dtype=object)


@F.pandas_udf(T.StructType().add("samples", T.BinaryType()).add("feature", T.StringType()))
def _load(media: pd.Series) -> pd.DataFrame:
    samples = [load_bytes(m) if m is not None else None for m in media]
    return pd.DataFrame({"samples": samples, "feature": [s if s is None else feature(s) for s in samples]}, dtype=object)


_IMAGES = T.ArrayType(T.StructType().add("width", T.IntegerType()).add("height", T.IntegerType()).add("pixels", T.BinaryType()))


@F.pandas_udf(T.StructType().add("images", _IMAGES).add("reason", T.StringType()))
def _pixels(media: pd.Series) -> pd.DataFrame:
    found, reasons = [], []
    for m in media:
        try:
            found.append(None if m is None else [{"width": p.shape[1], "height": p.shape[0], "pixels": channels(p).tobytes()} for p in images(m)])
            reasons.append(None)
        except (ValueError, IndexError, OverflowError, MemoryError) as e:  # whatever damaged bytes lead to
            found.append(None)
            reasons.append(str(e) or type(e).__name__)
    return pd.DataFrame({"images": found, "reason": reasons}, dtype=object)


def feature(samples: bytes) -> str:
    """Samples' sum, number of different ones, changes from one to the next, and largest."""
    x = np.frombuffer(samples, np.uint8)
    return f"sum={int(x.sum(dtype=np.int64))};different={int((np.bincount(x) > 0).sum())};changes={int((x[1:] != x[:-1]).sum())};largest={int(x.max()) if len(x) else 0}"


def store_text(text: Column) -> Column:
    """Lossless WebP of a text's padded UTF-8; a null text is stored as an empty one."""
    return _store(text)


def load_samples(media: Column) -> Column:
    """``samples`` and ``feature`` of media of :func:`store_text`; null stays null."""
    return _load(media)


def try_decode(media: Column) -> Column:
    """``images`` (``width``, ``height`` and ``pixels``: blue, green, red, alpha bytes) of each lossless WebP file in a binary column, and ``reason``.

    Null stays null, empty bytes have no image. A damaged file, or one that is no lossless WebP, has null images and the
    reason, and stops no other.
    """
    return _pixels(media)


def decode_pixels(media: Column) -> Column:
    """The images of :func:`try_decode`; null for what can't be read."""
    return _pixels(media)["images"]


def media_columns(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``media``, ``samples`` read back from it, and ``feature``, for every document.

    Texts are stored and read back in one pass, ``BATCH_BYTES`` at a time. A null text counts as empty and is stored
    as one row of zeros; other columns are not read.
    """
    slim = id_and_text(docs)
    names = ["doc_id", "n_bytes", "media", "samples", "feature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column(1), BATCH_BYTES):
                media = [store_bytes(padded(t)) for t in texts.to_pylist()]
                samples = [load_bytes(m) for m in media]
                columns = [batch.column(0).slice(at, len(texts)), pc.binary_length(texts).cast(pa.int64()), pa.array(media, pa.binary()), pa.array(samples, pa.binary()), pa.array([feature(s) for s in samples])]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return slim.mapInArrow(run, f"doc_id {dict(slim.dtypes)['doc_id']}, n_bytes long, media binary, samples binary, feature string")


def op10_webp_lossless(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    found = media_columns(table(spark, sf_dir, "documents"))
    size = F.octet_length("samples").cast("long")
    return found.select(
        "doc_id", "n_bytes", size.alias("payload_bytes"), F.sha2("samples", 256).alias("payload_sha256"), F.crc32(F.substring("samples", -ROW, ROW)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "feature",
    )


QUERIES = {"op10_webp_lossless": op10_webp_lossless}
SQL: dict[str, str] = {}
