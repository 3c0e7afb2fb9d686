import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from glossaria.llm import byte_bpe as b
from tests.conftest import SMALL

from .odd import ROWS, documents

PIECES = ["a", " ", "\n", "  ", "b", "é", "1", "23", "'s", "!", "中", "文", "\t", "ab", " the", "\x1c", " ", " ", "🙂", "ing", "\r\n", "don't", "."]


@pytest.fixture(scope="module")
def bpe():
    return b.load_bpe(public_tokenizers.path(b.VOCABULARY))


@pytest.fixture(scope="module")
def theirs(bpe):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def test_encodes_as_tiktoken_does(bpe, theirs):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40))) for _ in range(4000)] + [r[1] or "" for r in ROWS] + ["a" * 3000, "中" * 2000, "ab" * 999]
    for ids, t in zip(b.BpeEncoder(bpe)(texts), texts, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(t) and bpe.decode(ids) == t.encode()


def test_arrays_and_positions_agree(bpe, theirs):
    rng = random.Random(2)
    words = [bytes(rng.choice(b"aehtin ") for _ in range(rng.randint(2, 60))) for _ in range(4000)] + [b"aa" * k for k in range(1, 40)]
    for w, ids in zip(words, bpe.merge_many(words), strict=True):
        assert ids.tolist() == bpe.merge_one(w) and (w in bpe.ranks or ids.tolist() == theirs._encode_single_piece(w))


def test_new_pairs_of_lower_rank_come_first():
    """The pair ab with x has a lower rank than ab itself, so it goes before the next ab."""
    ranks = {bytes([k]): k for k in range(256)} | {b"xa": 256, b"abx": 257, b"ab": 258, b"bx": 400, b"abxab": 401}
    own = b.Bpe(ranks, public_tokenizers.PATTERN)
    for text in (b"ab", b"abab", b"abxab", b"ababxabx", b"xaxab"):
        assert own.merge_many([text])[0].tolist() == own.merge_one(text) == slow(ranks, text)


def slow(ranks, text):
    """Lowest rank, leftmost first, found anew for every merge."""
    parts = [bytes([c]) for c in text]
    while True:
        found = min(((ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if x + y in ranks), default=None)
        if found is None:
            return [ranks[p] for p in parts]
        i = found[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_random_vocabularies():
    rng = random.Random(3)
    for _ in range(60):
        words = {bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 4))) for _ in range(12)}
        ranks = {bytes([k]): k for k in range(256)} | {t: 256 + k for k, t in enumerate(rng.sample(sorted(words), len(words)))}
        own = b.Bpe(ranks, public_tokenizers.PATTERN)
        texts = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 25))) for _ in range(40)]
        for t, ids in zip(texts, own.merge_many(texts), strict=True):
            assert ids.tolist() == own.merge_one(t) == slow(ranks, t)


def test_rank_queue():
    rng, queue, held = random.Random(4), b.RankQueue(70_000), set()
    for _ in range(5000):
        r = rng.randrange(70_000)
        (queue.remove if r in held else queue.add)(r)
        held ^= {r}
        assert queue.first() == min(held, default=-1)


def test_query(spark, theirs):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in b.op8_byte_bpe(spark, SMALL).collect():
        ids = theirs.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_odd_rows(spark, theirs):
    rows = b.tokenize(documents(spark), with_decoded=True).collect()
    assert len(rows) == len(ROWS) and all(r["n_tokens"] == 0 for r in rows if r["doc_id"] in (3, 4))
    assert b.tokenize(documents(spark, [])).count() == 0
    columns = documents(spark).where("doc_id = 8").select(b.encode(b.F.col("text")).alias("e")).select("e", b.decode(b.F.col("e")).alias("d")).first()
    assert bytes(columns["d"]).decode() == ROWS[10][1] and np.frombuffer(columns["e"], "<u4").tolist() == theirs.encode_ordinary(ROWS[10][1])


def test_full_cache_changes_nothing(bpe, theirs):
    small = b.BpeEncoder(bpe, size=5)
    for t in ["some words here and longerwordsthere", "some words here and longerwordsthere", "other words"]:
        assert np.frombuffer(small([t])[0], "<u4").tolist() == theirs.encode_ordinary(t)
