"""A writer for every feature of the format: the inverse of what the reader undoes."""

import numpy as np

from glossaria.llm import webp as w


def tiles_of(height, width, bits):
    return -(-height >> bits), -(-width >> bits)


def forward_predictor(pixels, modes, bits):
    have = w.channels(pixels).astype(np.int32)
    out = have.copy()
    height, width = pixels.shape
    for y in range(height):
        for x in range(width):
            if y == 0:
                guess = np.array([0, 0, 0, 255]) if x == 0 else have[0, x - 1]
            elif x == 0:
                guess = have[y - 1, 0]
            else:
                beyond = have[y - 1, x + 1] if x + 1 < width else have[y, 0]
                guess = w.predict(int(modes[y >> bits, x >> bits]), have[y, x - 1], have[y - 1, x], beyond, have[y - 1, x - 1])
            out[y, x] = (have[y, x] - guess) & 255
    return w.numbers(out)


def forward_cross_colour(pixels, factors, bits):
    parts = w.channels(pixels).astype(np.int32)
    f = w._by_tile(w.channels(factors), bits, pixels.shape)
    green, red = parts[..., 1].copy(), parts[..., 2].copy()
    parts[..., 2] = (red - w.colour_delta(f[..., 0].view(np.int8), green)) & 255
    parts[..., 0] = (parts[..., 0] - w.colour_delta(f[..., 1].view(np.int8), green) - w.colour_delta(f[..., 2].view(np.int8), red)) & 255
    return w.numbers(parts)


def write(pixels, transforms=(), cache_bits=0, repeats=(), rng=None):
    """``transforms``: ``predictor``, ``cross``, ``green``, ``palette`` in the order they are applied."""
    writer = w.Writer()
    height, width = pixels.shape
    w.header(writer, width, height)
    for name in transforms:
        if name == "predictor":
            modes = rng.integers(0, 14, tiles_of(*pixels.shape, 2))
            writer.put_list([(1, 1), (w.PREDICTOR, 2), (0, 3)])
            w.put_pixels(writer, (modes.astype(np.uint32) << 8) | np.uint32(0xFF000000), main=False)
            pixels = forward_predictor(pixels, modes, 2)
        elif name == "cross":
            factors = rng.integers(0, 1 << 24, tiles_of(*pixels.shape, 3)).astype(np.uint32) | np.uint32(0xFF000000)
            writer.put_list([(1, 1), (w.CROSS_COLOUR, 2), (1, 3)])
            w.put_pixels(writer, factors, main=False)
            pixels = forward_cross_colour(pixels, factors, 3)
        elif name == "green":
            writer.put_list([(1, 1), (w.SUBTRACT_GREEN, 2)])
            parts = w.channels(pixels)
            parts[..., (0, 2)] -= parts[..., 1:2]
            pixels = w.numbers(parts)
        else:
            colours, index = np.unique(pixels, return_inverse=True)
            index = index.reshape(pixels.shape)
            steps = w.channels(colours).astype(np.int64)
            steps[1:] -= steps[:-1].copy()
            writer.put_list([(1, 1), (w.PALETTE, 2), (len(colours) - 1, 8)])
            w.put_pixels(writer, w.numbers(steps & 255), main=False)
            pack = w._pack_bits(len(colours))
            index = np.pad(index, ((0, 0), (0, -pixels.shape[1] % (1 << pack))))
            green = (index.reshape(height, -1, 1 << pack) << np.arange(1 << pack) * (8 >> pack)).sum(2)
            pixels = green.astype(np.uint32) << 8 | np.uint32(0xFF000000)
    writer.put(0, 1)
    w.put_pixels(writer, pixels, repeats, cache_bits)
    return w.file_of(writer.bytes())


def write_tiled(pixels, bits, groups):
    """Groups of prefix codes by tile: each tile's group number is its place modulo ``groups``."""
    writer = w.Writer()
    height, width = pixels.shape
    w.header(writer, width, height)
    writer.put_list([(0, 1), (0, 1), (1, 1), (bits - 2, 3)])
    tiles = (np.arange(np.prod(tiles_of(height, width, bits))) % groups).reshape(tiles_of(height, width, bits))
    w.put_pixels(writer, (tiles.astype(np.uint32) << 8) | np.uint32(0xFF000000), main=False)
    flat, group = pixels.ravel(), w._by_tile(tiles, bits, pixels.shape).ravel()
    codes = []
    for g in range(groups):
        own = w.channels(flat[group == g])
        lengths = [w.code_lengths(np.bincount(own[:, k], minlength=280 if k == 1 else 256)) for k in (1, 2, 0, 3)]
        sizes = [writer.code(x) for x in lengths]
        writer.code(np.zeros(40, np.int32))
        codes.append((sizes, [w.canonical(x) for x in lengths]))
    for p, g in zip(w.channels(flat).tolist(), group.tolist(), strict=True):
        sizes, words = codes[g]
        writer.put_list([(int(words[k][p[c]]), int(sizes[k][p[c]])) for k, c in enumerate((1, 2, 0, 3)) if sizes[k][p[c]]])
    return w.file_of(writer.bytes())
