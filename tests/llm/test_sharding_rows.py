from collections import Counter

from glossaria.llm import sharding as s

from .odd import ROWS, documents


def test_each_row_is_written_once(spark, tmp_path):
    """Null ids, repeated ids, and equal rows beyond the limit."""
    rows = [*ROWS, *[(7, "t" * 90, "de", f"copy {k}", k) for k in range(40)], *[(None, "n" * 90, "de", f"copy {k}", k) for k in range(40)]]
    before, s.RANKED_TOGETHER = s.RANKED_TOGETHER, 7
    try:
        s.write_shards(documents(spark, rows, clash=False), str(tmp_path / "out"), 1000)
    finally:
        s.RANKED_TOGETHER = before
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert Counter((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in found) == Counter(rows)
    held = {}
    for r in found:
        held.setdefault(r["shard"], []).append(len((r["text"] or "").encode()))
    assert all(sum(x) <= 1000 or len(x) == 1 for x in held.values())
