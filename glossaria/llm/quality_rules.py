"""Quality rules by weak supervision.

Each rule looks at counts of a text and votes ``good`` (1), ``bad`` (-1) or abstains (0). Nobody says which rule is
right: expectation-maximisation over the number of documents with each pattern of votes estimates, for good and for
bad documents, how often each rule votes which way, and how many documents are good. A document's posterior
probability of being good then replaces the filter that wants every rule to pass.

The counts come from one Arrow-batched pass over the texts; votes, patterns and the join of posteriors are Spark
expressions. There are at most ``3 ** len(RULES)`` patterns whatever the size of the corpus, so their counts may go
to the driver and their posteriors may be broadcast.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossaria.llm.common import UPPER, bound_batches, id_and_text, stage, table

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_shouts", "n_short")

#: A text fails without a vote under this many words, or with over this share of its words in repeated 3-word windows.
MIN_WORDS = 50
MAX_REPEAT = 0.5
#: A document is kept from this posterior probability on.
KEEP_AT = 0.5
#: Weight of the first guess against the data, as a share of all documents, alike at every size.
PRIOR_WEIGHT = 0.02
ROUNDS = 200


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, the first occurrence included."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    again = np.fromiter((times[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(windows)] |= again
    return int(covered.sum())


def count_text(text: str | None) -> tuple[int, ...]:
    """The ``COUNTS`` of a whole text; null counts as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip(SPACES)]
    without = lambda drop: len(raw) - len(raw.translate(None, drop))
    return (
        len(words), len(text or "") - without(SPACES), without(SYMBOLS), len(lines) - len(set(lines)), repeated_words(words),
        len(lines), without(UPPER.encode()), raw.count(b"!"), sum(1 for w in words if len(w) < 4 and w != b"|"),
    )


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def _counts(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([count_text(t) for t in texts], columns=COUNTS, dtype="int64")


def counts(text: Column) -> Column:
    """A struct of ``COUNTS`` of a text column."""
    return _counts(text)


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules(c) -> dict[str, Column]:
    """The votes; ``c(name)`` is the column of a count. Rules about shares abstain on texts without a word."""
    some = c("n_words") > 0
    share = lambda a, b: c(a) / F.greatest(c(b), F.lit(1))
    between = lambda x, least, most: (x >= least) & (x <= most)
    return {
        "symbols": _vote(share("n_symbols", "n_words") > 0.1, some & (share("n_symbols", "n_words") < 0.005)),
        "capitals": _vote(share("n_upper", "word_chars") > 0.4, some & (share("n_upper", "word_chars") < 0.15)),
        "shouting": _vote(share("n_shouts", "n_words") > 0.2, F.lit(False)),
        "repeats": _vote(share("n_repeat_words", "n_words") > 0.2, c("n_words").between(100, 10**9) & (share("n_repeat_words", "n_words") < 0.02)),
        "word_length": _vote(some & ~between(share("word_chars", "n_words"), 3, 10), between(share("word_chars", "n_words"), 3.8, 8)),
        "short_words": _vote(some & (share("n_short", "n_words") < 0.1), share("n_short", "n_words") > 0.25),
        "length": _vote(c("n_words") < MIN_WORDS, c("n_words") >= 120),
    }


RULES = ("symbols", "capitals", "shouting", "repeats", "word_length", "short_words", "length")


def base_failed(c) -> Column:
    return (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > round(100 * MAX_REPEAT) * c("n_words"))


def fit(votes: np.ndarray, times: np.ndarray, weight: float = PRIOR_WEIGHT, rounds: int = ROUNDS) -> tuple[float, np.ndarray]:
    """Expectation-maximisation over vote patterns.

    ``votes``: a row of -1, 0, 1 per pattern; ``times``: documents with it. Returns the share of good documents and
    ``p[class, rule, vote + 1]``, class 1 being good. The first guess, that a rule votes bad on 3 in 10 bad documents
    and on 1 in 50 good ones, stays in the sums as ``weight`` times all documents; it also fixes which class is which.
    """
    n, k = times.sum(), votes.shape[1]
    one_hot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    marginal = np.einsum("n,nrv->rv", times, one_hot) / max(n, 1)
    guess = np.empty((2, k, 3))
    for cls, bad in ((0, 0.3), (1, 0.02)):
        rest = marginal[:, 1:] + 1e-3
        guess[cls] = np.column_stack([np.full(k, bad), (1 - bad) * rest / rest.sum(1, keepdims=True)])
    p, good = guess.copy(), 0.8
    for _ in range(rounds):
        post = posterior(votes, good, p)
        was = good
        good = (times @ post + weight * n * 0.8 + 1e-9) / (n * (1 + weight) + 1e-9 / 0.8)
        for cls, w in ((0, times * (1 - post)), (1, times * post)):
            p[cls] = (np.einsum("n,nrv->rv", w, one_hot) + (weight * n + 1e-9) * guess[cls]) / (w.sum() + weight * n + 1e-9)
        if abs(good - was) < 1e-12:
            break
    return float(good), p


def posterior(votes: np.ndarray, good: float, p: np.ndarray) -> np.ndarray:
    """The probability of being good for each row of votes."""
    at = votes + 1
    like = [np.log(share) + np.log(p[cls][np.arange(votes.shape[1]), at]).sum(1) for cls, share in ((0, 1 - good), (1, good))]
    return 1 / (1 + np.exp(np.clip(like[0] - like[1], -700, 700)))


def _pattern(c) -> Column:
    return F.concat_ws(",", *(v.cast("string") for v in rules(c).values()))


def pattern_posteriors(patterned: DataFrame) -> DataFrame:
    """``pattern`` and ``posterior`` of every pattern of votes in the column ``pattern`` of a table, a row per document."""
    spark = patterned.sparkSession
    seen = patterned.groupBy("pattern").count().orderBy("pattern").collect()  # at most 3 ** len(RULES) rows
    if not seen:
        return spark.createDataFrame([], "pattern string, posterior double")
    votes = np.array([[int(v) for v in r["pattern"].split(",")] for r in seen])
    good, p = fit(votes, np.array([r["count"] for r in seen], float))
    return spark.createDataFrame([(r["pattern"], float(x)) for r, x in zip(seen, posterior(votes, good, p), strict=True)], "pattern string, posterior double")


def judge(counted: DataFrame, posteriors: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    """Adds ``posterior``, ``base_failed`` and ``kept`` to a table with the columns ``COUNTS``."""
    judged = counted.withColumn("pattern", _pattern(F.col)).join(F.broadcast(posteriors), "pattern", "left").drop("pattern")
    return judged.withColumn("base_failed", base_failed(F.col)).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_at))


def quality(docs: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    """A row per document: ``doc_id``, the counts, ``posterior``, ``base_failed``, ``kept``.

    A null text counts as empty and fails; null and repeated ids are judged row by row; other columns are not read.
    An empty table gives an empty result. Every text is read whole, once.
    """
    counted = stage(id_and_text(docs).select("doc_id", counts(F.col("text")).alias("c")).select("doc_id", "c.*"), "quality-counts")
    return judge(counted, pattern_posteriors(counted.select(_pattern(F.col).alias("pattern"))), keep_at)


def keep_good(docs: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    """The documents that :func:`quality` keeps, with all their columns and without a shuffle of texts.

    Every text is counted once: the rows are written beside their votes, as no key ties a document to its counts when
    ids are null or repeat. Rows that fail at once count for the model but are not written.
    """
    counted = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), counts(F.col("text")).alias("c")).select("doc", "c.*")
    voted = counted.select("doc", _pattern(F.col).alias("pattern"), base_failed(F.col).alias("failed"))
    held = stage(voted.select(F.when(~F.col("failed"), F.col("doc")).alias("doc"), "pattern", "failed"), "quality-votes")
    posteriors = pattern_posteriors(held)
    return held.where("not failed").join(F.broadcast(posteriors), "pattern").where(F.col("posterior") >= keep_at).select("doc.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    found = quality(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("posterior", 6).alias("posterior"))


QUERIES = {"op2_quality_rules": op2_quality_rules}
SQL: dict[str, str] = {}
