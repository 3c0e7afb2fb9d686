import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from glossaria.llm import simhash as s
from glossaria.llm.components import connected_components
from tests.conftest import SMALL

from .odd import CLASH, ROWS, documents


def plain(text, width=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, radius=4):
    values = np.array(values, np.uint64)
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[:i]) <= radius).tolist():
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_fingerprints(spark):
    for t in [r[1] for r in ROWS] + ["A b", "ÄB c D e"]:
        assert s.fingerprint(t) % (1 << 64) == plain(t)
    assert spark.range(1).select(s.F.xxhash64(s.F.lit("a b c d"))).first()[0] == s.fingerprint("A b C d")


def test_query_against_all_pairs(spark):
    path = SMALL.replace("0.001", "0.01")
    rows = sorted(s.op9_simhash(spark, path).collect(), key=lambda r: r["doc_id"])
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    assert [r["fingerprint"] for r in rows] == [f"{plain(texts[r['doc_id']]):016x}" for r in rows]
    group = roots([int(r["fingerprint"], 16) for r in rows])
    assert [r["component_id"] for r in rows] == [rows[g]["doc_id"] for g in group]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_links_of_clusters(spark, seed):
    """Clusters of very near, near and far fingerprints: no link is lost, none is made up."""
    rng = random.Random(seed)
    values = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        values.add(centre)
        for _ in range(60):
            x = centre
            for b in rng.sample(range(64) if rng.random() < 0.7 else range(20, 30), rng.randint(1, 7)):
                x ^= 1 << b
            values.add(x)
    values = sorted(values, key=lambda v: (v ^ 1 << 63))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    order = sorted(range(len(values)), key=lambda k: signed[k])
    values, signed = [values[k] for k in order], [signed[k] for k in order]
    found = dict(s.link_groups(spark.createDataFrame([(x,) for x in signed], "fp long")).collect())
    group = roots(values)
    size = Counter(group)
    assert found == {signed[k]: signed[g] for k, g in enumerate(group) if size[g] > 1}


def test_every_split_of_four_bits_is_found(spark):
    rng = random.Random(8)
    pairs = []
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), 4):
            b ^= 1 << k
        pairs.append((a, b))
    sign = lambda v: v - (1 << 64) if v >> 63 else v
    found = dict(s.link_groups(spark.createDataFrame([(sign(x),) for p in pairs for x in p], "fp long")).collect())
    assert all(found[sign(a)] == found[sign(b)] == min(sign(a), sign(b)) for a, b in pairs)


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 9), (5, 5), (7, None), *((k, k + 1) for k in range(100, 160))]
    for small in (1000, 0):  # in one task, and in rounds
        found = dict(connected_components(spark.createDataFrame(edges, "a long, b long"), small).collect())
        assert found == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8, 5: 5} | {k: 100 for k in range(100, 161)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark):
    docs = documents(spark)
    rows = s.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    ids = {(r["doc_id"], r["component_id"]) for r in rows}
    assert {(1, 1), (2, 1), (3, 3), (4, 3), (5, 3), (None, 3), (6, 6), (7, 7)} <= ids
    kept = s.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and all(r[c] == f"own {c}" for r in kept.collect() for c in CLASH)
    assert Counter(r["doc_id"] for r in kept.collect()) == {1: 1, 3: 1, 6: 1, 7: 1, 8: 1, 9: 1, None: 2}
    assert s.near_duplicates(documents(spark, [])).count() == 0 and s.drop_near_duplicates(documents(spark, [])).count() == 0


def test_types(spark):
    assert s.near_duplicates(documents(spark)).schema["component_id"].dataType == T.LongType()
