"""Bibliographies: entries, their keys, and citations that don't resolve.

A text is taken apart by a fold over its tokens that carries the depth of braces and whether a quotation is open. An entry
reaches from its ``@`` to the brace, or parenthesis, that closes it, whatever lines in it begin with; what stands between
entries is kept. The parts of a text, strung together, are the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossaria.functions.text import count_character, key_list

#: What opens an entry, single characters that count, and runs of all others.
_TOKENS = r"@\s*\w+\s*[{(]|[@{}\"()]|[^@{}\"()]+"
#: An entry with a key, up to the key; comments, strings and preambles have none.
_KEYED = r"^(@\s*(?!(?i:comment|string|preamble)\b)\w+\s*[{(]\s*)([^,{}\s]+?)(?=\s*[,}]|\s*\)\s*$|\s)"


def _cuts(tokens: Column) -> Column:
    """Where parts begin, as indices of tokens, and how many tokens there are.

    The fold's state: ``within`` an entry (1: in braces, 2: in parentheses), the ``depth`` of braces, an open ``quote``, ``n`` tokens so far.
    """
    number, state = F.lit(0), lambda within, depth, quote, n, cuts: F.struct(within.alias("within"), depth.alias("depth"), quote.alias("quote"), n.alias("n"), cuts.alias("cuts"))

    def step(s: Column, t: Column) -> Column:
        last, outer, n = F.right(t, F.lit(1)), F.lit(2) - s["within"], s["n"] + 1  # outer: the depth at which nothing but the entry is open
        opens = (s["within"] == 0) & t.rlike("^@.")
        closes = ~s["quote"] & (((s["within"] == 1) & (t == "}") & (s["depth"] == 1)) | ((s["within"] == 2) & (t == ")") & (s["depth"] == 0)))
        depth = F.when(s["within"] == 0, 0).when(last == "{", s["depth"] + 1).when((t == "}") & (s["depth"] > outer), s["depth"] - 1).otherwise(s["depth"])
        quote = s["quote"] != ((s["within"] > 0) & (t == '"') & (s["depth"] == outer))
        inside = state(s["within"], depth, quote, n, s["cuts"])
        begun = state(F.when(last == "{", 1).otherwise(2), F.when(last == "{", 1).otherwise(0), F.lit(False), n, F.array_append(s["cuts"], s["n"]))
        return F.when(opens, begun).when(closes, state(number, number, F.lit(False), n, F.array_append(s["cuts"], n))).otherwise(inside)

    return F.aggregate(tokens, state(number, number, F.lit(False), number, F.array(number)), step, lambda s: F.array_append(s["cuts"], s["n"]))


def pieces(text: Column) -> Column:
    """The text in parts: entries, and what stands before, between and after them. An entry that is never closed reaches to the end.

    Quotes count outside inner braces only, and a brace that nothing has opened does not end a quotation.
    """
    part = lambda t, c, k: F.array_join(F.slice(t, F.get(c, k - 1) + 1, F.get(c, k) - F.get(c, k - 1)), "")
    cut = lambda t, c: F.filter(F.transform(F.sequence(F.lit(1), F.size(c) - 1), lambda k: part(t, c, k)), lambda p: p != "")
    tokens = F.regexp_extract_all(text, F.lit(_TOKENS), F.lit(0))
    return F.transform(F.array(tokens), lambda t: F.transform(F.array(_cuts(t)), lambda c: cut(t, c))[0])[0]  # tokens and cuts are made once


def key_of(piece: Column) -> Column:
    """The key of an entry; null for what has none."""
    return F.nullif(F.regexp_extract(piece, _KEYED, 2), F.lit(""))


def rekey_piece(piece: Column, dataset: Column) -> Column:
    """The part with the dataset in front of its key, if it has one."""
    return F.regexp_replace(piece, F.lit(_KEYED), F.concat(F.lit("$1"), F.regexp_replace(dataset, r"([\\$])", r"\\$1"), F.lit("_$2")))


def rekey_text(text: Column, dataset: Column) -> Column:
    """The text with the dataset in front of each entry's key; order and everything else stay."""
    return F.array_join(F.transform(pieces(text), lambda p: rekey_piece(p, dataset)), "")


def rekey(df: DataFrame, dataset: str = "Dataset", value: str = "value") -> DataFrame:
    return df.withColumn(value, rekey_text(F.col(value), F.col(dataset)))


def entries(df: DataFrame, dataset: str = "Dataset", value: str = "value") -> DataFrame:
    """``Dataset``, ``pos``, ``key``, ``text``: a row per part of each text, in its order, keys as they are.

    Strings, preambles, comments and text outside entries are rows without a key. White space around a part is not in it.
    """
    rows = df.select(F.col(dataset).alias("Dataset"), F.posexplode(pieces(F.col(value))).alias("pos", "text")).where(F.col("text").rlike(r"\S"))
    return rows.select("Dataset", F.col("pos").cast("long").alias("pos"), key_of(F.col("text")).alias("key"), F.regexp_replace("text", r"^\s+|\s+$", "").alias("text"))


def rekeyed_entries(df: DataFrame, dataset: str = "Dataset", value: str = "value") -> DataFrame:
    """:func:`entries` with the dataset in front of each key, in the text as well."""
    rows = entries(df, dataset, value)
    return rows.withColumns({"key": F.concat("Dataset", F.lit("_"), "key"), "text": rekey_piece(F.col("text"), F.col("Dataset"))})


def entry_counts(df: DataFrame, value: str = "value") -> DataFrame:
    """One row: ``@`` signs, which over-count, and entries with a key."""
    n = F.size(F.filter(pieces(F.col(value)), lambda p: key_of(p).isNotNull()))
    return df.agg(F.coalesce(F.sum(count_character(F.col(value), "@")), F.lit(0)).alias("at_signs"), F.coalesce(F.sum(F.greatest(n, F.lit(0)).cast("long")), F.lit(0)).alias("entries"))


def unresolved(forms: DataFrame, found: DataFrame, source: str = "Source", dataset: str = "Dataset", key: str = "key") -> DataFrame:
    """Distinct ``Dataset`` and ``key`` that forms cite and no entry has."""
    cited = forms.select(F.col(dataset).alias("Dataset"), F.explode(key_list(F.col(source))).alias("key")).distinct()
    return cited.join(found.select(F.col(dataset).alias("Dataset"), F.col(key).alias("key")), ["Dataset", "key"], "left_anti")


def unresolved_count(forms: DataFrame, found: DataFrame) -> DataFrame:
    """One row: ``invalid_bibtex_references``, the keys of :func:`unresolved`."""
    return unresolved(forms, found).agg(F.count(F.lit(1)).alias("invalid_bibtex_references"))
