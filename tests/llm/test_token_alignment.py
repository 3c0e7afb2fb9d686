import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from glossaria.llm import token_alignment as t
from tests.conftest import SMALL

from .odd import ROWS, documents


def tokens(texts):
    """Ids and bytes of each whole text by either library, or nothing where the bytes differ."""
    a = Tokenizer.from_file(public_tokenizers.path(t.VOCABULARY_A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(t.VOCABULARY_B))
    shown = sorted(ByteLevel.alphabet(), key=ord)
    plain = [c for c in shown if ord(c) < 256]
    byte = {c: ord(c) for c in plain} | dict(zip([c for c in shown if ord(c) > 255], [x for x in range(256) if chr(x) not in plain], strict=True))
    out = []
    for text in texts:
        found = ([], [], [], [])
        if text:
            ids_a = a.encode(" " + text, add_special_tokens=False).ids
            ids_b = b.encode(text)
            bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
            bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in (b.id_to_piece(i),)]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                found = (ids_a, np.cumsum([len(x) for x in bytes_a]).tolist(), ids_b, np.cumsum([len(x) for x in bytes_b]).tolist())
        out.append(found)
    return out


def expected(rows):
    """All pairs of tokens whose byte ranges overlap, counted over all texts."""
    each = []
    for ids_a, ends_a, ids_b, ends_b in tokens(text for _, text in rows):
        common = set(ends_b)
        cuts = [e for e in ends_a if e in common]
        groups, links, at_a, at_b = [], [], 0, 0
        for cut in cuts:
            to_a, to_b = ends_a.index(cut, at_a) + 1, ends_b.index(cut, at_b) + 1
            groups.append(",".join(map(str, ids_a[at_a:to_a])) + "|" + ",".join(map(str, ids_b[at_b:to_b])))
            for p in range(at_a, to_a):
                for q in range(at_b, to_b):
                    if max(ends_a[p - 1] if p else 0, ends_b[q - 1] if q else 0) < min(ends_a[p], ends_b[q]):
                        links.append((ids_a[p], ids_b[q]))
            at_a, at_b = to_a, to_b
        each.append((len(ids_a), len(ids_b), groups, links))
    counts = Counter(x for *_, links in each for x in links)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return Counter(
        (i, n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for (i, _), (n_a, n_b, groups, links) in zip(rows, each, strict=True)
    )


def found(df):
    return Counter((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in df.collect())


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert found(t.op11_token_alignment(spark, SMALL)) == expected(rows)


TEXTS = [
    " leading", "  two", "\nline\n", "trailing ", "a  b   c", "x▁y", "▁", "<|endoftext|> a<|endoftext|>", "<s> </s> <unk>", "....... ---- ....", "aaaaaaaaaaaaaaaaaaaaaaaaa", "é ́x 漢字 🙂🙂 　 a", "a  b", "0 00 000 0000 12345678", "\0 \0a", "a\n b", "a\t b\r\n c",
    "don't 've we'll", "ﬁ ½ ²", "=" * 300, "ha" * 200, " ", "a\x85b \x1cc", "𝔘𝔫𝔦 ℵ",
]


def test_odd_texts(spark, monkeypatch):
    rng = random.Random(2)
    parts = [*" \n\t.,'aAé漢1▁", "the ", "ing", "🙂", "  ", "== ", "word word "]
    rows = [(i, x) for i, x in enumerate(TEXTS + ["".join(rng.choices(parts, [8] * 10 + [2] + [6] * (len(parts) - 11), k=rng.randint(1, 30))) for _ in range(400)])]
    assert found(t.align_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))) == expected(rows)


def test_odd_rows(spark):
    docs = documents(spark).withColumns({c: F.lit(1) for c in ("block", "whole", "pairs", "times", "pair", "count", "best", "n_a")})
    assert found(t.align_documents(docs)) == expected([(r[0], r[1]) for r in ROWS])
    assert t.align_documents(documents(spark, [])).count() == 0
    assert found(t.align_documents(docs.where("text is null or text = ''"))) == expected([(r[0], r[1]) for r in ROWS if not r[1]])


@pytest.mark.parametrize("size", [1, 5000])
def test_small_blocks(spark, size):
    """Counts are the corpus's, however documents are dealt out to blocks."""
    rows = [(f"d{i}", f"the thing that is {'thin' * (i % 5)} and other than") for i in range(200)]
    before, t.BLOCK_BYTES = t.BLOCK_BYTES, size
    try:
        assert found(t.align_documents(spark.createDataFrame(rows, "doc_id string, text string").repartition(4))) == expected(rows)
    finally:
        t.BLOCK_BYTES = before


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.booleans()), max_size=80), st.integers(0, 40), st.integers(0, 40))
def test_groups_of_ends(cuts, before, after):
    """Random ends with long stretches that are alike: each group ends where both sides do, and no earlier."""
    cuts = [(True, True)] * before + cuts + [(True, True)] * (after + 1)
    a = np.array([k + 1 for k, (x, _) in enumerate(cuts) if x])
    b = np.array([k + 1 for k, (_, y) in enumerate(cuts) if y])
    groups, at_a, at_b = [], 0, 0
    for i, p, j, q in t.aligned(a, b):
        assert (i, j) == (at_a, at_b)
        at_a, at_b = p, q
        alike = p - i == q - j and a[i] == b[j]
        groups += [(k, k + 1, k - i + j, k - i + j + 1) for k in range(i, p)] if alike else [(i, p, j, q)]
    assert [int(a[p - 1]) for _, p, _, _ in groups] == [int(b[q - 1]) for *_, q in groups] == sorted(set(a.tolist()) & set(b.tolist()))


def test_long_stretches_are_jumped_over():
    ends = np.arange(1, 100_001)
    assert t.aligned(ends, ends) == [(0, 100_000, 0, 100_000)]
    assert t.aligned(np.delete(ends, 50_000), ends) == [(0, 50_000, 0, 50_000), (50_000, 50_001, 50_000, 50_002), (50_001, 99_999, 50_002, 100_000)]
