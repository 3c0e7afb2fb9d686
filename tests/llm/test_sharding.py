import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from glossaria.llm import sharding as s

from .odd import ROWS, documents


def split(rows, limit):
    """Buckets of (bits, bytes) rows, splitting what is too large."""
    out, todo = {}, [("", rows)]
    while todo:
        prefix, held = todo.pop()
        if sum(b for _, b in held) <= limit or len(held) == 1 or len(prefix) >= 128:
            out |= {prefix: len(held)} if held else {}
        else:
            todo += [(prefix + d, [r for r in held if r[0][len(prefix)] == d]) for d in "01"]
    return out


def test_only_large_buckets_split(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('x', cast(20 + id % 300 as int)) as text")
    for limit in (200_000, 20_000, 3_000, 700):
        rows = [(f"{int(hashlib.md5(str(i).encode()).hexdigest(), 16):0128b}", 20 + i % 300) for i in range(3000)]
        got = Counter(r["shard"] for r in s.assign_shards(docs, limit).collect())
        assert got == split(rows, limit)


def test_odd_rows(spark):
    found = s.assign_shards(documents(spark), 1000).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in ROWS)
    held = defaultdict(list)
    for r in found:
        held[r["shard"]].append(r["bytes"])
    assert all(sum(x) <= 1000 or len(x) == 1 for x in held.values())
    assert s.assign_shards(documents(spark, []), 1000).count() == 0


def test_one_key_and_equal_rows_beyond_the_limit(spark):
    """A third of all rows under one key, half of them equal: no shard is too large and no row is lost."""
    docs = spark.range(600).selectExpr("if(id % 3 = 0, 1, id) as doc_id", "if(id % 6 = 0, repeat('same', 25), concat(repeat('t', 90), lpad(id, 10, '0'))) as text")
    found = s.assign_shards(docs, 1000).groupBy("shard").agg({"bytes": "sum", "*": "count"}).collect()
    assert sum(r["count(1)"] for r in found) == 600 and max(r["sum(bytes)"] for r in found) <= 1000


@pytest.mark.parametrize("limit", [1000, 400, 10**9])
def test_written_shards(spark, tmp_path, limit):
    """A plain reader finds the shards that were assigned, one alone included, whose name has no bits."""
    docs = documents(spark, [r for r in ROWS if r[0] is not None and r[0] != 2]).drop("id")
    s.write_shards(docs, str(tmp_path / "out"), limit)
    found = {(r["doc_id"], r["shard"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    numbered = docs.withColumn("__row", F.monotonically_increasing_id())
    assert found == {(r["doc_id"], "b" + r["shard"]) for r in s._assign(numbered, limit, ("__row",)).collect()}
    assert limit < 10**9 or {x for _, x in found} == {"b"}
