"""Connected components of a graph whose edges are a DataFrame."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossaria.llm.common import stage


#: Distinct edges that are put together in one task, 16 bytes each where nodes are longs.
SMALL_EDGES = 200_000


def _stars(edges: DataFrame) -> DataFrame:
    """One round: every node's larger neighbours, then its smaller ones and itself, move to its smallest neighbour."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    large = both.join(least, both.a == least.n).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
    moved = large.join(low, large.a == low.n).select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").distinct()


def _at_once(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Components of all edges of a task, by uniting trees."""
    above: dict = {}

    def top(x):
        while (up := above.setdefault(x, x)) != x:
            above[x] = x = above[up]
        return x

    for batch in batches:
        for x, y in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            low, high = sorted((top(x), top(y)))
            above[high] = low
    yield pd.DataFrame({"node": list(above), "root": [top(x) for x in above]})


def connected_components(edges: DataFrame, small: int = SMALL_EDGES) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of ``edges`` (two columns of one type).

    Up to ``small`` counted edges go to one task; more take large-star and small-star rounds, each written to the shared
    folder, until no edge changes. Loops, repeated and reversed edges make no difference; edges with a null are
    dropped; no edges give no rows.
    """
    a, b = edges.columns
    ends = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    now = stage(ends.select(F.least(a, b).alias("b"), F.greatest(a, b).alias("a")).select("a", "b").distinct(), "edges")
    if now.count() <= small:
        kind = dict(now.dtypes)["a"]
        return now.coalesce(1).mapInPandas(_at_once, f"node {kind}, root {kind}")
    nodes = now.select(F.col("a").alias("node")).union(now.select(F.col("b").alias("node"))).distinct()
    print_of = lambda df: tuple(df.where("a <> b").agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first())
    seen, now = print_of(now), now.where("a <> b")
    while seen[0]:
        now = stage(_stars(now), "stars")
        found = print_of(now)
        if found == seen:
            break
        seen = found
    return nodes.join(now.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").withColumn("root", F.coalesce("root", "node"))
