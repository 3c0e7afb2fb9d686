"""Keys, lists, flags and numbers that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = r"[\s\x1c-\x1f]"


def strip(c: Column) -> Column:
    """``c`` without white space of any script at its ends."""
    bare = F.ascii(c).between(33, 126) & F.ascii(F.right(c, F.lit(1))).between(33, 126)  # visible ASCII at both ends: nothing to look for
    return F.when(bare, c).otherwise(F.regexp_replace(F.regexp_replace(c, rf"(?U)^{_SPACE}+", ""), rf"(?U){_SPACE}+$", ""))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def prefix_id(dataset: Column, c: Column) -> Column:
    """``dataset_key``. A null cell is an empty one and gives ``dataset_``, so that empty keys still meet each other."""
    return F.concat(dataset, F.lit("_"), F.coalesce(c, F.lit("")))


def prefix_value(dataset: Column, c: Column) -> Column:
    """The whole cell prefixed once, even if it holds a list; null and empty stay null."""
    return F.concat(dataset, F.lit("_"), empty_to_null(c))


def key_list(c: Column, sep: str = ";") -> Column:
    """The stripped, non-empty elements of a list cell."""
    return F.filter(F.transform(F.split(c, f"\\Q{sep}\\E"), strip), lambda k: k != "")


def prefix_keys(dataset: Column, c: Column, sep: str = ";") -> Column:
    """A list cell with each element prefixed; null if nothing is left.

    With a separator of one visible character no list is made: separators and the white space around them become one
    separator, those at the ends go.
    """
    if len(sep) == 1 and not sep.isspace():
        runs = F.regexp_replace(c, rf"(?U){_SPACE}*\Q{sep}\E(?:{_SPACE}|\Q{sep}\E)*", rf"\{sep}" if sep in "\\$" else sep)
        plain = empty_to_null(F.btrim(strip(F.when(c.contains(sep), runs).otherwise(c)), F.lit(sep)))
        return F.concat(dataset, F.lit("_"), F.replace(plain, F.lit(sep), F.concat(F.lit(sep), dataset, F.lit("_"))))
    return empty_to_null(F.array_join(F.transform(key_list(c, sep), lambda k: F.concat(dataset, F.lit("_"), k)), sep))


def decode_boolean(c: Column) -> Column:
    """True for ``true``, false for ``false``, null for all else, ``True`` included."""
    return F.when(c == "true", True).when(c == "false", False)


def number(c: Column) -> Column:
    """A decimal number or infinity as double; all else, ``nan`` and type suffixes included, is null."""
    bare = strip(c)
    plain = bare.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    endless = F.lower(bare).rlike("^[+-]?inf(inity)?$")
    return F.when(plain, bare.try_cast("double")).when(endless, F.when(bare.startswith("-"), float("-inf")).otherwise(float("inf")))


def combine(*parts: Column, sep: str = ";") -> Column:
    """The parts that are not null, joined; null if none is."""
    return empty_to_null(F.concat_ws(sep, *parts))


def url_fragment(c: Column) -> Column:
    """What follows the last ``#``; all of it without one."""
    return F.substring_index(c, "#", -1)


def count_character(c: Column, character: str) -> Column:
    return (F.length(c) - F.length(F.replace(c, F.lit(character), F.lit("")))).cast("long")


def contains_pattern(c: Column, pattern: str) -> Column:
    """Whether a regular expression finds something; null is false."""
    return F.coalesce(c.rlike(pattern), F.lit(False))
