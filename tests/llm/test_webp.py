import random
import hashlib
import itertools
import zlib

import numpy as np
import pytest

from glossaria.llm import webp as w
from tests.conftest import SMALL

from . import webp_writer
from .odd import ROWS, documents


def picture(rng, height, width, colours=None):
    if colours:
        return rng.choice(rng.integers(0, 1 << 32, colours, dtype=np.uint32), (height, width))
    x = np.add.outer(np.arange(height), np.arange(width))
    parts = np.stack([(x * k + rng.integers(0, 9, x.shape)) & 255 for k in (1, 2, 3, 0)], -1)
    return w.numbers(parts)


def test_known_file():
    """One red pixel, spelled bit by bit as in the format's description."""
    writer = w.Writer()
    w.header(writer, 1, 1)
    writer.put_list([(0, 1), (0, 1), (0, 1)])  # no transform, no cache, no tiles
    for symbol in (0, 255, 0, 255, 0):
        writer.put_list([(1, 1), (0, 1), (1, 1), (symbol, 8)])
    assert next(w.images(w.file_of(writer.bytes()))).tolist() == [[0xFFFF0000]]


@pytest.mark.parametrize("names", [n for k in range(4) for n in itertools.permutations(("predictor", "cross", "green"), k)] + [("palette",), ("palette", "predictor")])
def test_transforms_and_cache(names):
    rng = np.random.default_rng(len(names) + 7)
    for size, cache in (((9, 13), 0), ((1, 1), 0), ((1, 17), 3), ((23, 1), 0), ((16, 31), 5)):
        pixels = picture(rng, *size, colours=9 if "palette" in names else None)
        assert (next(w.images(webp_writer.write(pixels, names, cache, rng=rng))) == pixels).all()


@pytest.mark.parametrize("colours", [1, 2, 3, 4, 5, 16, 17, 200])
def test_palettes(colours):
    rng = np.random.default_rng(colours)
    pixels = picture(rng, 11, 19, colours)
    for cache in (0, 1, 11):
        assert (next(w.images(webp_writer.write(pixels, ("palette",), cache))) == pixels).all()


def test_groups_of_codes_by_tile():
    rng = np.random.default_rng(1)
    for bits, groups in ((2, 3), (3, 2), (4, 5)):
        pixels = picture(rng, 21, 37)
        assert (next(w.images(webp_writer.write_tiled(pixels, bits, groups))) == pixels).all()


def test_back_references_near_and_far():
    rng = np.random.default_rng(3)
    flat = picture(rng, 30, 40).ravel()
    flat[100:150] = flat[40:90]
    flat[200:300] = flat[199]  # overlaps itself
    flat[600:1100] = flat[3:503]
    repeats = [(100, 50, 60), (200, 100, 1), (600, 500, 597)]
    for cache in (0, 4):
        assert (next(w.images(webp_writer.write(flat.reshape(30, 40), ("green",) if not cache else (), cache, [] if not cache else repeats))) == flat.reshape(30, 40)).all()
    assert (next(w.images(webp_writer.write(flat.reshape(30, 40), (), 0, repeats))) == flat.reshape(30, 40)).all()


def test_short_distances_name_neighbours():
    assert len(w.NEIGHBOURS) == 120 and w.NEIGHBOURS[:6] == [(0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0)] and w.NEIGHBOURS[-3:] == [(-7, 7), (8, 6), (8, 7)]
    for value in [*range(1, 200), 4096, 1_000_000]:
        symbol, extra, n = w.prefix(value)
        writer = w.Writer()
        writer.put_list([(extra, n), (0, 8)])
        assert w._extra(w.Bits(writer.bytes()), symbol) == value


def test_payloads_round_trip():
    rng = np.random.default_rng(9)
    texts = [r[1] for r in ROWS] + ["\0" * 500, "ab" * 4000, "one line of text\n" * 300, "x", "".join(map(chr, rng.integers(1, 0xD000, 4000)))]
    for t in texts:
        payload = w.padded(t)
        assert len(payload) % 64 == 0 and payload and w.load_bytes(w.store_bytes(payload)) == payload
    large = rng.integers(0, 256, (1 << 20) + 640, dtype=np.uint8).tobytes()
    assert len(list(w.images(w.store_bytes(large)))) == 2 and w.load_bytes(w.store_bytes(large)) == large


def test_damaged_files_are_errors():
    media = w.store_bytes(w.padded("some text that is stored " * 20))
    for bad in (media[:40], b"RIFFxxxxWEBPVP8 ", media[:20] + b"\0" + media[21:]):
        with pytest.raises(w.WebpError):
            w.load_bytes(bad)


def test_query_against_plain_payloads(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = w.op10_webp_lossless(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        payload = w.padded(texts[r["doc_id"]])
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(texts[r["doc_id"]].encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))


def test_odd_rows_and_columns(spark):
    rows = w.media_columns(documents(spark)).collect()
    assert len(rows) == len(ROWS) and {bytes(r["samples"]) for r in rows if r["doc_id"] in (3, 4)} == {bytes(64)}
    assert w.media_columns(documents(spark, [])).count() == 0
    shown = w.media_columns(documents(spark)).where("doc_id = 7").select(w.decode_pixels(w.F.col("media")).alias("p")).first()["p"]
    assert (shown[0]["width"], shown[0]["height"], bytes(shown[0]["pixels"][1::4])) == (64, 1, b"one" + bytes(61))


def test_damaged_files_stop_no_others(spark):
    whole = w.store_bytes(w.padded("some text and more of it"))
    rng = random.Random(4)
    broken = [whole[:n] for n in range(0, len(whole), 7)] + [bytes(b ^ (rng.random() < 0.05) * rng.randrange(256) for b in whole) for _ in range(60)] + [b"RIFF", b"not an image"]
    df = spark.createDataFrame([(-1, whole), (-2, None), *enumerate(broken)], "k int, m binary")
    rows = {r["k"]: r["d"] for r in df.select("k", w.try_decode(df["m"]).alias("d")).collect()}
    assert len(rows) == len(broken) + 2 and rows[-1]["reason"] is None and rows[-1]["images"][0]["width"] > 0 and rows[-2] == (None, None)
    assert rows[len(broken) - 1]["images"] is None and rows[len(broken) - 1]["reason"]
    assert all((r["images"] is None) == (r["reason"] is not None) for k, r in rows.items() if k != -2)
