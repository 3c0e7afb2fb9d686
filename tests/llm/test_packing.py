import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from glossaria.llm import packing as p
from tests.conftest import SMALL

from .odd import ROWS, documents


def check_places(rows, capacity=p.CAPACITY):
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def expected(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(p.VOCABULARY))
    out = []
    for i, t in texts:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        starts = [0, *range(first, len(ids), 2048)]
        for k, (a, z) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            out.append((i, k, a, z - a, zlib.crc32(np.array(ids[a:z], "<u4").tobytes())))
    return Counter(out)


def test_query(spark):
    rows = p.op7_best_fit_packing(spark, SMALL).collect()
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected(texts)
    assert check_places(rows) <= -(-sum(r["length"] for r in rows) // p.CAPACITY) + 1


def test_odd_rows(spark):
    rows = p.pack_documents(documents(spark), with_ids=True).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected([(r[0], r[1]) for r in ROWS])
    check_places(rows)
    assert all(len(r["ids"]) == 4 * r["length"] for r in rows)
    assert p.pack_documents(documents(spark, [])).count() == 0


def test_plan_uses_each_piece_once_and_few_sequences():
    rng = random.Random(5)
    for capacity, lengths in ((100, range(1, 101)), (100, (60, 30, 10, 7)), (64, (33,)), (2048, (1, 2047, 1024, 683, 682))):
        counts = {x: rng.randint(1, 500) for x in lengths}
        plan = p.Plan(counts, capacity)
        used = Counter()
        for pattern, times in plan.patterns:
            assert sum(pattern) <= capacity and times > 0
            for x in pattern:
                used[x] += times
        assert used == counts
        ranks = defaultdict(list)
        for x, a, z, _, _ in plan.slots():
            ranks[x].append((a, z))
        for x, parts in ranks.items():
            assert sorted(parts)[0][0] == 0 and all(a == z for (_, z), (a, _) in zip(sorted(parts), sorted(parts)[1:], strict=False)) and sorted(parts)[-1][1] == counts[x]


def test_exact_complements():
    plan = p.Plan({})
    plan.left = np.zeros(2049, np.int64)
    plan.left[[48, 1000, 700, 300, 348]] = 1
    plan.counts = plan.left.copy()
    assert plan.exact(48) == [48] and plan.exact(1300) == [1000, 300] and plan.exact(1348) in ([1000, 348], [700, 348, 300]) and plan.exact(1096) == [700, 348, 48] and plan.exact(1097) == [] and plan.exact(2000) == [1000, 700, 300]
    assert plan.exact(96) == []  # one piece of 48 can't be used twice
    best = p.Plan({1000: 10, 600: 10, 448: 10})
    assert best.patterns == [([1000, 600, 448], 10)]


def test_index_finds_what_a_search_finds():
    """While lengths run out, the index has a combination for a gap whenever there is one, and never one that isn't left."""
    rng = random.Random(8)
    for _ in range(20):
        capacity = 60
        plan = p.Plan({}, capacity)
        plan.left = np.array([0] + [rng.choice((0, 0, 1, 2)) for _ in range(capacity)], np.int64)
        plan.counts = plan.left.copy()
        while plan.left.any():
            gap = rng.randint(1, capacity)
            have = Counter({x: int(n) for x, n in enumerate(plan.left) if n})
            lengths = [x for x, n in have.items() for _ in range(min(n, 3))]
            there = any(sum(c) == gap for k in (1, 2, 3) for c in itertools.combinations(lengths, k))
            found = plan.exact(gap)
            assert bool(found) == there and (not found or sum(found) == gap and not Counter(found) - have)
            for x in found or [rng.choice(lengths)]:
                plan.left[x] -= 1
            plan.counts = plan.left.copy()


def test_a_length_that_most_pieces_share(spark):
    """Ranks are dealt out in groups; places stay whole."""
    before, p.RANKED_TOGETHER = p.RANKED_TOGETHER, 50
    try:
        found = spark.range(2000).selectExpr("id as doc_id", "0 as piece", "0L as start", "if(id % 3 = 0, id % 1999 + 1, 600L) as length")
        rows = p.pack(found).collect()
    finally:
        p.RANKED_TOGETHER = before
    assert len(rows) == 2000 and check_places(rows) <= -(-sum(r["length"] for r in rows) // 2048) * 1.2
