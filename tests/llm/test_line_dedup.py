import random
from collections import Counter, defaultdict

from glossaria.llm import line_dedup as d

from .odd import CLASH, ROWS, documents


def plain(rows, sites=10, words=3):
    spread, first = defaultdict(set), {}
    for i, text, site in rows:
        for line in (text or "").split("\n"):
            if len(line.encode().split()) >= words:
                if site is not None:
                    spread[line].add(site)
                if i is not None:
                    first[line] = min(first.get(line, i), i)
    bad = {x for x, s in spread.items() if len(s) >= sites}
    clean = lambda i, t: t if t is None else "\n".join(x for x in t.split("\n") if x not in bad or x not in first or i == first[x])
    return Counter((i, clean(i, t)) for i, t, _ in rows)


def test_against_brute_force_round_the_threshold(spark):
    rng = random.Random(2)
    pool = [f"the line number {k} stands here" for k in range(60)] + ["too short", "", " ", "a b c"]
    rows = []
    for i in range(400):
        picked = [pool[min(len(pool) - 1, int(rng.expovariate(0.06)))] for _ in range(rng.randint(0, 5))]
        rows.append((rng.choice([i, i, i, None]), "\n".join(picked) if rng.random() > 0.05 else None, rng.choice([f"s{int(rng.expovariate(0.15))}", None])))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for sites in (3, 10):
        assert Counter((r["doc_id"], r["text"]) for r in d.remove_boilerplate(docs, min_sites=sites).collect()) == plain(rows, sites)


def test_odd_rows(spark):
    out = d.remove_boilerplate(documents(spark), min_sites=2)
    rows = out.collect()
    assert set(out.columns) == set(documents(spark).columns) and all(r[c] == f"own {c}" for r in rows for c in CLASH if c != "n_removed")
    assert Counter((r["doc_id"], r["text"]) for r in rows) == plain([(r[0], r[1], r[3]) for r in ROWS], 2)
    assert sum(r["n_removed"] for r in rows if r["doc_id"] == 2) == 2
    assert d.remove_boilerplate(documents(spark, [])).count() == 0


def test_line_of_most_documents(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('own words of ', id, '\nshared by all of them') as text", "concat('s', id % 50) as source")
    out = d.remove_boilerplate(docs)
    assert out.where("n_removed = 1").count() == 2999 and out.where("text like '%shared%'").first()["doc_id"] == 0
