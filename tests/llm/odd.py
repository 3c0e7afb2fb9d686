"""Tables with nulls, empty and long texts, repeated rows and clashing columns."""

LONG = " ".join(f"word{i % 997}x{i}" for i in range(20_000))
PROSE = "The quick brown fox jumps over the lazy dog and then it walks home along the river, where many of the other animals wait. "

ROWS = [
    (1, PROSE * 3, "en", "a", 10), (2, PROSE * 3, "en", "b", 10), (2, PROSE * 3, "en", "b", 10), (3, None, "en", None, None), (4, "", None, "a", 0), (None, "no id here", "en", "a", 10),
    (None, None, None, None, None), (5, " \n\t \n", "en", "c", 5), (6, LONG, "en", "c", len(LONG)), (7, "one", "de", "b", 3), (8, "ÀÉ 漢字 🙂 mixed Text\u00a0here\nsame\nsame\n", "fr", "c", 4), (9, "a\0b " * 30, "fr", "c", 4),
]
#: Names that operators use inside or add.
CLASH = ("id", "site", "line", "key", "kept", "pattern", "posterior", "fp", "part", "root", "n_removed", "sequence_id", "piece", "shard", "bytes", "host", "verdict", "length", "ids", "samples")


def documents(spark, rows=ROWS, clash=True):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if clash:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit(f"own {c}") for c in CLASH})
    return df
