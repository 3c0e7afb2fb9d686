"""Files spelled from the format's description without the repository's writer, and the reader against plain loops."""

import numpy as np
import pytest

from glossaria.llm import webp as w


def spelled(fields):
    """Bytes of numbers and their bits, lowest bit first."""
    total, at = 0, 0
    for value, n in fields:
        total |= value << at
        at += n
    return total.to_bytes(-(-at // 8), "little")


def chunk(kind, body):
    return kind + len(body).to_bytes(4, "little") + body + bytes(len(body) & 1)


def riff(*chunks):
    body = b"WEBP" + b"".join(chunks)
    return b"RIFF" + len(body).to_bytes(4, "little") + body


def one_pixel(argb):
    """An entropy-coded image whose pixels are all alike: five codes of one symbol, so no bits for pixels."""
    a, r, g, b = argb >> 24, argb >> 16 & 255, argb >> 8 & 255, argb & 255
    return [x for symbol in (g, r, b, a, 0) for x in ((1, 1), (0, 1), (1, 1), (symbol, 8))]


def stream(width, height, transforms, pixel):
    out = [(0x2F, 8), (width - 1, 14), (height - 1, 14), (1, 1), (0, 3)]
    for kind, size_bits, argb in transforms:
        out += [(1, 1), (kind, 2)] + ([(size_bits - 2, 3), (0, 1), *one_pixel(argb)] if size_bits else [])
    return spelled(out + [(0, 1), (0, 1), (0, 1), *one_pixel(pixel)])


def guess(mode, left, top, right, corner):
    """The prediction for one channel list, by the description's names: L, T, TR, TL."""
    mean = lambda a, b: [(x + y) // 2 for x, y in zip(a, b, strict=True)]
    clamp = lambda x: min(255, max(0, x))
    if mode == 11:
        p = [a + b - c for a, b, c in zip(left, top, corner, strict=True)]
        far = lambda q: sum(abs(x - y) for x, y in zip(p, q, strict=True))
        return left if far(left) < far(top) else top
    return {
        0: lambda: [255, 0, 0, 0], 1: lambda: left, 2: lambda: top, 3: lambda: right, 4: lambda: corner, 5: lambda: mean(mean(left, right), top), 6: lambda: mean(left, corner),
        7: lambda: mean(left, top), 8: lambda: mean(corner, top), 9: lambda: mean(top, right), 10: lambda: mean(mean(left, corner), mean(top, right)),
        12: lambda: [clamp(a + b - c) for a, b, c in zip(left, top, corner, strict=True)],
        13: lambda: [clamp(m + int((m - c) / 2)) for m, c in zip(mean(left, top), corner, strict=True)],
    }[mode]()


def predicted(rest, mode):
    """Pixels as lists of alpha, red, green, blue, from rows of what the predictions leave."""
    out = [[None] * len(rest[0]) for _ in rest]
    for y, row in enumerate(rest):
        for x, r in enumerate(row):
            if y == 0:
                p = [255, 0, 0, 0] if x == 0 else out[0][x - 1]
            elif x == 0:
                p = out[y - 1][0]
            else:
                p = guess(mode, out[y][x - 1], out[y - 1][x], out[y - 1][x + 1] if x + 1 < len(row) else out[y][0], out[y - 1][x - 1])
            out[y][x] = [(a + b) & 255 for a, b in zip(p, r, strict=True)]
    return out


def parts(argb):
    return [argb >> 24, argb >> 16 & 255, argb >> 8 & 255, argb & 255]


def argb(pixels):
    return [[a << 24 | r << 16 | g << 8 | b for a, r, g, b in row] for row in pixels]


@pytest.mark.parametrize("mode", range(14))
def test_each_predictor(mode):
    for left in (0x01234567, 0xF0E1D2C3):
        data = riff(chunk(b"VP8L", stream(7, 5, [(0, 2, 0xFF000000 | mode << 8)], left)))
        assert next(w.images(data)).tolist() == argb(predicted([[parts(left)] * 7] * 5, mode))
    rng = np.random.default_rng(mode)
    rest = rng.integers(0, 1 << 32, (9, 11), dtype=np.uint32)
    got = w.invert_predictor(rest, np.full((3, 3), mode), 2)
    assert got.tolist() == argb(predicted([[parts(int(p)) for p in row] for row in rest], mode))


def signed(x):
    return x - 256 if x > 127 else x


@pytest.mark.parametrize("factors", [0x00000000, 0x0012F37A, 0x0080FF01])
def test_cross_colour(factors):
    to_blue_red, to_blue, to_red = signed(factors >> 16 & 255), signed(factors >> 8 & 255), signed(factors & 255)
    for pixel in (0xFF102030, 0x80F0C8FA):
        a, r, g, b = parts(pixel)
        red = (r + (to_red * signed(g) >> 5)) & 255
        blue = (b + (to_blue * signed(g) >> 5) + (to_blue_red * signed(red) >> 5)) & 255
        assert next(w.images(riff(chunk(b"VP8L", stream(3, 2, [(1, 3, factors)], pixel))))).tolist() == argb([[[a, red, g, blue]] * 3] * 2)


def test_subtract_green_and_order_of_transforms():
    a, r, g, b = parts(0x11FEDC98)
    assert next(w.images(riff(chunk(b"VP8L", stream(2, 2, [(2, 0, 0)], 0x11FEDC98))))).tolist() == argb([[[a, (r + g) & 255, g, (b + g) & 255]] * 2] * 2)
    # What is written first was applied first and is undone last.
    rest = predicted([[parts(0x01020304)] * 3] * 3, 2)
    want = [[[a, (r + g) & 255, g, (b + g) & 255] for a, r, g, b in row] for row in rest]
    assert next(w.images(riff(chunk(b"VP8L", stream(3, 3, [(2, 0, 0), (0, 2, 0xFF000200)], 0x01020304))))).tolist() == argb(want)


def test_extended_containers():
    one, two = (chunk(b"VP8L", stream(2, 1, [], p)) for p in (0xFF0000FF, 0xFF00FF00))
    profile, extra = chunk(b"ICCP", b"abc"), chunk(b"EXIF", b"\0" * 5)
    data = riff(chunk(b"VP8X", bytes(10)), profile, one, extra, chunk(b"XMP ", b"<x/>"))
    assert [p.tolist() for p in w.images(data)] == [[[0xFF0000FF] * 2]]
    frames = riff(chunk(b"VP8X", bytes(10)), chunk(b"ANIM", bytes(6)), *(chunk(b"ANMF", bytes(16) + c) for c in (one, two)))
    assert [p.tolist() for p in w.images(frames + data)] == [[[0xFF0000FF] * 2], [[0xFF00FF00] * 2], [[0xFF0000FF] * 2]]
    for bad in (riff(chunk(b"VP8X", bytes(10)), profile), riff(chunk(b"VP8 ", bytes(10))), data[:-3], riff(chunk(b"VP8X", bytes(10)), b"VP8L\xff\0\0\0abc")):
        with pytest.raises(w.WebpError):
            list(w.images(bad))


def test_feature_by_plain_loops():
    for data in (b"", b"\0" * 64, b"aab\xffb" * 20, bytes(range(256))):
        changes = sum(1 for k in range(1, len(data)) if data[k] != data[k - 1])
        assert w.feature(data) == f"sum={sum(data)};different={len(set(data))};changes={changes};largest={max(data, default=0)}"


def test_null_and_empty_media(spark):
    media = w.store_bytes(w.padded("x"))
    df = spark.createDataFrame([(1, None), (2, b""), (3, media)], "k int, m binary")
    shown = {r["k"]: r["p"] for r in df.select("k", w.decode_pixels(df["m"]).alias("p")).collect()}
    assert shown[1] is None and shown[2] == [] and len(shown[3]) == 1
    read = {r["k"]: r["s"]["samples"] for r in df.select("k", w.load_samples(df["m"]).alias("s")).collect()}
    assert read[1] is None and bytes(read[2]) == b"" and bytes(read[3]) == b"x" + bytes(63)
