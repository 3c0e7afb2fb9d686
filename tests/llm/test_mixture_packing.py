import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from glossaria.llm import mixture_packing as m
from tests.conftest import SMALL

from .odd import ROWS, documents


def ids_of(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(m.VOCABULARY))
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


def check(rows, texts, capacity=m.CAPACITY):
    """Every id of every document in one piece, all sequences without gaps, and none padded. ``texts``: pairs of id and text, ids unique."""
    ids = {i: x for (i, _), x in zip(texts, ids_of(t for _, t in texts), strict=True)}
    held, of = defaultdict(list), defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
        of[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    assert set(of) == set(ids)
    for i, parts in of.items():
        at = 0
        for start, length, crc, n in sorted(parts):
            assert start == at and length > 0 and n == len(ids[i]) and crc == zlib.crc32(np.array(ids[i][start : start + length], "<u4").tobytes())
            at += length
        assert at == len(ids[i])
    sizes = []
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        sizes.append(at)
    assert all(x == capacity or x < capacity and x & (x - 1) == 0 for x in sizes)
    assert len(set(x for x in sizes if x != capacity)) == len([x for x in sizes if x != capacity])
    return held


def mixture(rows, capacity=m.CAPACITY):
    """Ids of each source in each full window, in order."""
    out = defaultdict(Counter)
    for r in rows:
        out[r["sequence_id"]][r["source"]] += r["length"]
    return [out[k] for k in sorted(out) if sum(out[k].values()) == capacity]


def test_query(spark):
    rows = m.op12_mixture_packing(spark, SMALL).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()])


def test_odd_rows(spark):
    rows = m.mix_documents(documents(spark), with_ids=True).collect()
    whole = Counter()
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        whole[r["doc_id"]] += r["length"]
    assert whole == sum((Counter({r[0]: len(x)}) for r, x in zip(ROWS, ids_of(r[1] for r in ROWS), strict=True)), Counter())
    assert {r["source"] for r in rows} == {"a", "b", "c", None}
    assert m.mix_documents(documents(spark, [])).count() == 0


TEXTS = ["A<|endoftext|>b it's", "<|startoftext|>", "é ́x Å", "İ ΑΣ ς", " a  b\n\nc\td ", "x　y z w", "don't we'll 123 a1b2", "\0 \0a", "ﬁ ½ 漢字 🙂🙂", "''s '' s", "a\x85b \x1cc", "́ ́", "H̱ J̌x Ạ̈", "H\x01 \x01 a", "<|ENDOFTEXT|> <|Endoftext|>", "A.B,C;;d .e !?x 1.2, é.É,", " \n x", "x\n\n \ny.\n"]


def test_ids_are_the_librarys(spark):
    rng = random.Random(1)
    parts = [*" \n\t'aAéÉ́<>|1 ", "<|endoftext|>", "the ", "'s", " '"]
    texts = TEXTS + ["".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(1500)]
    words = m._words(public_tokenizers.path(m.VOCABULARY))
    got = [np.frombuffer(x, "<u4").tolist() for x in words(pa.array(texts))]
    assert got == [x[:-1] for x in ids_of(texts)]


@pytest.mark.parametrize("grain", [16, 64])
def test_windows_have_the_sources_shares(spark, grain):
    """No window, nor any run of them, is off by more than two packets; sources of few ids wait until they have a packet."""
    rng = random.Random(7)
    rows = [(i, " ".join(["word"] * rng.randint(1, 300)), source) for i, source in enumerate(rng.choices(["hot", "b", "c", "rare", None], [60, 25, 10, 1, 4], k=800))]
    got = m.mix_documents(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7), 256, grain).collect()
    check(got, [(i, t) for i, t, _ in rows], 256)
    total = Counter()
    for r in got:
        total[r["source"]] += r["length"]
    windows, so_far = mixture(got, 256), Counter()
    for k, w in enumerate(windows, 1):
        so_far += w
        for s in total:
            share = 256 * total[s] / total.total()
            assert abs(so_far[s] - k * share) <= share + grain * (1 + len(total)), (k, s)
            assert abs(w[s] - share) <= share + 2 * grain
    spread = [w["hot"] for w in windows]
    assert max(spread) - min(spread) <= 4 * grain + 5


def test_targets(spark):
    """Given weights hold until a queue ends; then the others have its share."""
    rows = [(i, " ".join(["word"] * 99), "ab"[i % 2]) for i in range(400)]
    got = m.mix_documents(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3), 512, 32, {"a": 3.0, "b": 1.0}).collect()
    check(got, [(i, t) for i, t, _ in rows], 512)
    windows = mixture(got, 512)
    assert all(abs(w["a"] - 384) <= 64 for w in windows[:50]) and all(w["a"] == 0 for w in windows[-20:])
    with pytest.raises(ValueError):
        m.mix_documents(spark.createDataFrame(rows, "doc_id long, text string, source string"), targets={"a": 0.0})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 9), min_size=1, max_size=5), min_size=1, max_size=8), st.sampled_from([9, 10, 16, 31]), st.randoms())
def test_cut(docs, capacity, rng):
    """Packets in any order of documents fill sequences without gaps; pieces tell where each id went."""
    order = [(d, k) for d, sizes in enumerate(docs) for k in range(len(sizes))]
    rng.shuffle(order)
    pos, at = {}, 0
    for d, k in order:
        pos[d, k] = at
        at += docs[d][k]
    keys = [(d, k) for d, sizes in enumerate(docs) for k in range(len(sizes))]
    arrays = [np.array(x) for x in ([d for d, _ in keys], [sum(docs[d][:k]) for d, k in keys], [docs[d][k] for d, k in keys], [pos[key] for key in keys])]
    tail, full = m._bounds(at, capacity)
    origin = [w * capacity for w in range(full)] + tail.tolist()
    ids = {(int(r), int(s) + x): origin[q] + int(o) + x for r, s, n, q, o in zip(*m._cut(*arrays, at, capacity), strict=True) for x in range(n)}
    assert ids == {(d, sum(docs[d][:k]) + x): pos[d, k] + x for d, k in keys for x in range(docs[d][k])}
    for r, s, n, q, o in zip(*m._cut(*arrays, at, capacity), strict=True):
        assert o + n <= ([capacity] * full + [b - a for a, b in zip(tail, [*tail[1:], at], strict=False)])[q]
