import ast
import os

import corpus_pipeline as c
from glossaria.llm import line_dedup, quality_rules, simhash
from glossaria.llm.common import stage
from glossaria.sources import staging
from tests.conftest import SMALL

from .odd import documents
from .test_line_dedup import plain as plain_lines
from .test_simhash_texts import groups, meet, rings

TOP = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {r["doc_id"] for r in quality_rules.op2_quality_rules(spark, SMALL).where("kept").collect()}
    good = stage(c.quality(spark, docs, SMALL), "t1")
    assert good.columns == docs.columns and {r["doc_id"] for r in good.collect()} == kept
    lined = stage(c.line_dedup(spark, good, SMALL), "t2")
    want = plain_lines([(r["doc_id"], r["text"], r["source"]) for r in good.collect()], line_dedup.MIN_SITES, line_dedup.MIN_WORDS)
    assert {(r["doc_id"], r["text"]) for r in lined.collect()} == {(i, t) for i, t in want if t.split()}
    assert lined.where("n_chars <> length(text)").count() == 0
    rows = sorted(lined.collect(), key=lambda r: r["doc_id"])
    ring = rings([r["text"] for r in rows])
    group = groups([r["text"] for r in rows], lambda i, j: meet(ring[i], ring[j]))
    single = stage(c.near_dedup(spark, lined, SMALL), "t3")
    assert {r["doc_id"] for r in single.collect()} == {rows[g]["doc_id"] for g in set(group)} and single.columns == docs.columns
    before = staging.staged(spark)
    assert {r["doc_id"] for r in c.run(spark, SMALL).collect()} == {r["doc_id"] for r in single.collect()}
    left = {os.path.basename(p).rsplit("-", 1)[0] for p in staging.staged(spark) if p not in before}
    assert left <= {"simhash_near_dedup", "pieces"}  # what the last stage reads; the rest is deleted on the way


def test_odd_documents_pass_all_stages(spark):
    for docs in (documents(spark), documents(spark, [])):
        for _, apply in c.STAGES:
            docs = stage(apply(spark, docs, ""), "odd")
        assert docs.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_nothing_else_imports_the_subpackage():
    for folder, _, names in os.walk(f"{TOP}/glossaria"):
        for name in names:
            if name.endswith(".py") and "/llm" not in folder:
                tree = ast.parse(open(f"{folder}/{name}").read())
                found = [n.module or "" for n in ast.walk(tree) if isinstance(n, ast.ImportFrom)] + [a.name for n in ast.walk(tree) if isinstance(n, ast.Import) for a in n.names]
                assert not [m for m in found if "llm" in m or "corpus_pipeline" in m]


def test_registry(spark):
    import __spark_entry__ as e

    names = e.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert simhash.RADIUS == 4
