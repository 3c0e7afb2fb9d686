import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from glossaria.llm import lexical_search as s
from tests.conftest import SMALL

from .odd import ROWS, documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(FOLD))


def expected(docs, items, top=s.TOP):
    """Every document scored for every item."""
    held = [(i, Counter(w), len(w)) for i, t in docs if (w := split(t))]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c, n in held:
            m = 75 + 25 * n * n_docs // total
            score = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, k in Counter(split(text)).items() if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, k, x[3], -x[0]) for k, x in enumerate(sorted(scored)[:top], 1)]
    return Counter(out)


def found(df):
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


ITEMS = [(1, "the quick LAZY dog, the fox"), (2, None), (3, ""), (4, " ,;- "), (5, "nothing_like_this"), (6, "漢字 àé ÀÉ same"), (7, "word1x1 word5x5 one"), (None, "fox one id"), (1, "the quick LAZY dog, the fox")]


@pytest.mark.parametrize("block", [1 << 20, 20])
def test_odd_rows(spark, block):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumns({c: F.lit(c) for c in ("rank", "doc_id", "score", "term", "n")})
    got = found(s.search(documents(spark).drop("rank").withColumn("score", F.lit(1)), items, block_bytes=block))
    assert got == expected([(r[0], r[1]) for r in ROWS], ITEMS)
    assert any(k[2] is None for k in got)


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert s.search(documents(spark, []), items).count() == 0
    assert s.search(documents(spark), items.limit(0)).count() == 0
    assert s.search(documents(spark), items.where("item_id in (2, 3, 4, 5)")).count() == 0


def test_ties_long_items_and_small_blocks(spark, monkeypatch):
    """Copies have equal scores; items of more than 64 terms have masks of several words; documents are ranked a few at a time."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(200)]
    pick = lambda n: " ".join(rng.choices(words, [1 / (k + 1) for k in range(200)], k=n))
    texts = [pick(rng.randint(1, 60)) for _ in range(150)]
    docs = [(i, rng.choice(texts)) for i in range(900)] + [(5, texts[0]), (5, texts[0])]
    items = [(f"i{k}", pick(rng.choice((3, 30, 400)))) for k in range(12)]
    monkeypatch.setattr(s, "DOCS_TOGETHER", 50)
    monkeypatch.setattr(s, "SCORED_TOGETHER", 7)
    shuffled = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert found(s.search(shuffled, spark.createDataFrame(items, "item_id string, text string"), top=7)) == expected(docs, items, 7)


def test_string_ids(spark):
    docs = [("b", "x y"), ("a", "y x"), ("c", "z"), (None, "x y")]
    got = found(s.search(spark.createDataFrame(docs, "doc_id string, text string"), spark.createDataFrame([(1, "x")], "item_id long, text string")))
    assert [k[2] for k in sorted(got, key=lambda k: k[1])] == ["a", "b", None]


def test_groups_stop_early():
    """Masks that cannot reach a place are not scored."""
    import numpy as np
    import pyarrow as pa

    n = 2000
    found_in = [[0, 1, 2, 3] if i < 30 else [3] for i in range(n)]
    ends = np.cumsum([len(x) for x in found_in])
    flat = np.array([t for x in found_in for t in x])
    of = s.Documents(pa.array(range(n)), np.full(n, 5), ends, flat, np.ones(len(flat), np.int64), np.array([9, 9, 9, 1]), n, 5 * n)
    asked, plain = [], s.Documents.scores
    of.scores = lambda item, which: asked.append(len(which)) or plain(of, item, which)
    item = s.Item({0: 1, 1: 1, 2: 1, 3: 1})
    of.rank(item, 20)
    assert sum(asked) == 30 and [x[2] for x in item.best] == list(range(20))


def test_query_against_all_pairs(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    by = defaultdict(list)
    for k in (got := found(s.op13_lexical_search(spark, SMALL))):
        by[k[0]].append(k[1])
    assert got == expected(docs, items) and all(sorted(r) == list(range(1, len(r) + 1)) for r in by.values())
