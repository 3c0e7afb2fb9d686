"""Ranked lexical search of a query set over all documents, by presence masks.

The query set is taken in blocks of bounded size. For each, documents are read once for their occurrences of the block's
terms; corpus figures are sums over these rows. Then each task ranks its documents a few thousand at a time: a bitmap for
each term of an item says which documents hold it, the bitmaps together are a mask for each document, and documents with
the same mask are one group. No document of a group can score more than the sum of its terms' highest contributions, so
groups are scored from the highest such sum on, until the sum falls below the item's last place so far. A task hands on
its best documents for each item, and these are ranked in two steps.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossaria.llm.common import LOWER, UPPER, bound_batches, stage, table

TOP = 20
#: Bytes of item texts that are searched for at once: bounds what is broadcast and what the driver holds.
BLOCK_BYTES = 4 << 20
#: Documents, and occurrences of terms in them, whose masks are grouped at once; documents that are scored at once.
DOCS_TOGETHER, FOUND_TOGETHER, SCORED_TOGETHER = 8192, 2_000_000, 256
#: Groups that a task's results are first ranked in.
SPREAD = 32

#: Bytes outside terms become spaces, A-Z small letters; bytes of other characters are part of terms.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text in order, as UTF-8: runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def occurrences(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id``, ``n`` (terms), ``terms`` (numbers of those in the vocabulary, each once, ascending), ``times``, for each document with a term."""
    kind = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            at, n, found, times = [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                if words := terms(text):
                    held = Counter(map(number, words))
                    held.pop(None, None)
                    at.append(i)
                    n.append(len(words))
                    found.append(sorted(held))
                    times.append([held[t] for t in found[-1]])
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(n, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "times"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, times array<int>")


class Item:
    """An item's terms, how often it has each, and its best documents so far, best first: (-score, id is null, id)."""

    def __init__(self, wanted: dict[int, int]):
        self.terms = np.array(sorted(wanted), np.int64)
        self.often = np.array([wanted[t] for t in sorted(wanted)], np.int64)
        self.best: list[tuple] = []

    def least(self, top: int) -> int:
        """The score below which no document gets a place; a place needs one above 0."""
        return max(1, -self.best[-1][0]) if len(self.best) == top else 1


class Documents:
    """A few thousand documents with their occurrences: ``worth`` is what each adds to a score for one occurrence of the term in an item."""

    def __init__(self, ids: pa.Array, n: np.ndarray, ends: np.ndarray, found: np.ndarray, times: np.ndarray, weights: np.ndarray, docs: int, total: int):
        self.ids, self.ends, self.found = ids, ends, found
        self.starts = np.append(0, ends[:-1])
        row = np.repeat(np.arange(len(n)), np.diff(np.append(0, ends)))
        m = 100 - 25 + (25 * n * docs) // total
        self.worth = weights[found] * ((1_000_000_000 * times) // (1000 * times + 12 * m[row]))
        order = np.argsort(found, kind="stable")
        self.rows, self.present = row[order], np.unique(found)
        self.first = np.searchsorted(found[order], self.present)
        self.last = np.append(self.first[1:], len(order))
        self.most = np.maximum.reduceat(self.worth[order], self.first) if len(order) else np.zeros(0, np.int64)
        self.place = np.empty(len(ids), np.int64)  # among the ids, nulls last
        self.place[pc.array_sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))

    def masks(self, at: np.ndarray) -> np.ndarray:
        """A row of 64-bit words for each document: bit k is set if it holds the k-th of the terms ``at`` (places in ``present``)."""
        words = np.zeros((len(self.ids), -(-len(at) // 64)), np.uint64)
        for k, t in enumerate(at.tolist()):
            words[self.rows[self.first[t] : self.last[t]], k // 64] |= np.uint64(1 << k % 64)
        return words

    def scores(self, item: Item, which: np.ndarray) -> np.ndarray:
        sizes = self.ends[which] - self.starts[which]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self.starts[which] - ends + sizes, sizes)
        k = np.minimum(np.searchsorted(item.terms, self.found[at]), len(item.terms) - 1)
        part = np.where(item.terms[k] == self.found[at], item.often[k], 0) * self.worth[at]
        return np.add.reduceat(part, ends - sizes)  # each has an occurrence, so none of the runs is empty

    def rank(self, item: Item, top: int) -> None:
        """Puts those of the documents that get a place into ``item.best``."""
        _, mine, at = np.intersect1d(item.terms, self.present, assume_unique=True, return_indices=True)
        if not len(at):
            return
        words = self.masks(at)
        held = np.flatnonzero(words.any(axis=1))
        words = words[held]
        kinds, group = np.unique(words[:, 0] if words.shape[1] == 1 else words.view(np.dtype((np.void, 8 * words.shape[1]))).ravel(), return_inverse=True)
        bits = np.unpackbits(np.ascontiguousarray(kinds).view(np.uint8).reshape(len(kinds), -1), axis=1, bitorder="little")[:, : len(at)]
        bound = bits.astype(np.int64) @ (item.often[mine] * self.most[at])
        by_group = held[np.argsort(group, kind="stable")]
        sizes = np.bincount(group, minlength=len(kinds))
        ends = np.cumsum(sizes)
        order = np.argsort(-bound, kind="stable")
        done = np.cumsum(sizes[order])
        k = 0
        while k < len(order) and bound[order[k]] >= item.least(top):
            till = max(k + 1, int(np.searchsorted(done, (done[k - 1] if k else 0) + SCORED_TOGETHER, side="right")))
            several = order[k:till]
            several = several[bound[several] >= item.least(top)]
            which = np.concatenate([by_group[ends[g] - sizes[g] : ends[g]] for g in several.tolist()])
            self._keep(item, which, self.scores(item, which), top)
            k = till

    def _keep(self, item: Item, which: np.ndarray, scores: np.ndarray, top: int) -> None:
        fits = scores >= item.least(top)
        which, scores = which[fits], scores[fits]
        first = np.lexsort((self.place[which], -scores))[:top]
        ids = self.ids.take(pa.array(which[first])).to_pylist()
        item.best = sorted(item.best + [(-s, i is None, i) for s, i in zip(scores[first].tolist(), ids, strict=True)], key=lambda x: x[:2] if x[1] else x)[:top]


def _searched(found: DataFrame, wanted: list[dict[int, int]], weights: list[int], docs: int, total: int, top: int) -> DataFrame:
    """``item`` (its number), ``doc_id``, ``score``, ``part``: the best documents of each item in each task."""
    kind = dict(found.dtypes)["doc_id"]
    shared = found.sparkSession.sparkContext.broadcast((wanted, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        items, worth = [Item(w) for w in shared.value[0]], np.array(shared.value[1], np.int64)
        for together in _gathered(batches):
            held = pa.Table.from_batches(together).combine_chunks()
            found, times = held.column("terms").combine_chunks(), held.column("times").combine_chunks()
            ends = np.cumsum(pc.list_value_length(found).to_numpy())
            of = Documents(held.column("doc_id").combine_chunks(), held.column("n").to_numpy(), ends, found.flatten().to_numpy().astype(np.int64), times.flatten().to_numpy().astype(np.int64), worth, docs, total)
            for item in items:
                of.rank(item, top)
        rows = [(k, x[2], -x[0]) for k, item in enumerate(items) for x in item.best]
        part = TaskContext.get().partitionId() % SPREAD
        schema = pa.schema([("item", pa.int32()), ("doc_id", id_kind), ("score", pa.int64()), ("part", pa.int32())])
        yield pa.RecordBatch.from_pydict({"item": [r[0] for r in rows], "doc_id": [r[1] for r in rows], "score": [r[2] for r in rows], "part": [part] * len(rows)}, schema)

    from pyspark.sql.pandas.types import to_arrow_type

    id_kind = to_arrow_type(found.schema["doc_id"].dataType)
    return found.mapInArrow(run, f"item int, doc_id {kind}, score long, part int")


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Batches put together to some thousand documents, no more than ``DOCS_TOGETHER`` and about ``FOUND_TOGETHER`` occurrences."""
    held, docs, found = [], 0, 0
    for batch in batches:
        for at in range(0, len(batch), 1024):
            part = batch.slice(at, 1024)
            n = pc.sum(pc.list_value_length(part.column(batch.schema.get_field_index("terms")))).as_py() or 0
            if held and (docs + len(part) > DOCS_TOGETHER or found + n > FOUND_TOGETHER):
                yield held
                held, docs, found = [], 0, 0
            held.append(part)
            docs, found = docs + len(part), found + n
    if held:
        yield held


def _best(rows: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score``: the ``top`` documents of each item with a score above 0, equal ones by ascending id.

    Nulls have no terms; a document without one is in no figure. Rows that share an id are documents of their own, a null
    id comes last among equal scores. Equal rows of items are one item; different texts under one id are ranked each.
    Items without a term, and empty tables, give no rows. Columns but the ids and texts are not read.
    """
    spark = docs.sparkSession
    asked = items.select("item_id", "text").where(F.length("text") > 0).distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    kinds = dict(asked.dtypes)["item_id"], dict(docs.dtypes)["doc_id"]
    out = [spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")]
    dealt = asked.withColumn("__block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks))))
    for k in range(blocks):
        held = [(r["item_id"], Counter(terms(r["text"]))) for r in dealt.where(F.col("__block") == k).collect()]  # bounded by block_bytes
        held = [(i, wanted) for i, wanted in held if wanted]
        if held:
            out.append(_search_block(docs, held, asked.schema["item_id"], top))
    return reduce(DataFrame.union, out)


def _search_block(docs: DataFrame, held: list, item_id, top: int) -> DataFrame:
    from pyspark.sql import types as T

    spark = docs.sparkSession
    vocabulary = {t: k for k, t in enumerate(sorted({t for _, wanted in held for t in wanted}))}
    found = stage(occurrences(docs, vocabulary), "occurrences")
    docs_n, total = found.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = {r["t"]: r["count"] for r in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}  # at most one row for each term of the block
    weights = [math.floor(1000 * math.log((2 * docs_n + 2) / (2 * df.get(k, 0) + 1))) for k in range(len(vocabulary))]
    wanted = [{vocabulary[t]: n for t, n in wanted.items()} for _, wanted in held]
    rows = _searched(found.where(F.size("terms") > 0), wanted, weights, docs_n, total or 1, top)
    best = _best(_best(rows, ["item", "part"], top).drop("rank"), ["item"], top)
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", item_id.dataType)])
    names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(held)], schema)
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

OP13_SQL = f"""
WITH words AS (SELECT doc_id, {_TERMS} AS found FROM documents WHERE text IS NOT NULL),
sized AS (SELECT doc_id, found, CAST(len(found) AS BIGINT) AS n FROM words WHERE len(found) > 0),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sized),
wanted AS (SELECT item_id, term, count(*) AS often FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL) GROUP BY ALL),
held AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(found) AS term FROM sized) WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, corpus GROUP BY term),
scored AS (
  SELECT item_id, doc_id, CAST(sum(often * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // total)))) AS BIGINT) AS score
  FROM held JOIN wanted USING (term) JOIN weights USING (term), corpus GROUP BY item_id, doc_id),
placed AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= {TOP}
"""

QUERIES = {"op13_lexical_search": op13_lexical_search}
SQL = {"op13_lexical_search": OP13_SQL}
