"""String functions as plain column expressions (no Python workers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The six characters of the regex class \s, and the page file ending.
WHITESPACE = " \t\n\x0b\f\r"
PAGE_SUFFIX = ".json"


def split_whitespace(text: Column) -> Column:
    """Cut at every single whitespace character.

    Empty tokens between and before separators stay, empty tokens at the end go.
    The empty text gives one empty token; a text of blanks only gives none.
    """
    stripped = F.rtrim(text, F.lit(WHITESPACE))
    blanks_only = (stripped == "") & (text != "")
    return F.when(~blanks_only, F.split(stripped, r"\s")).otherwise(
        F.when(blanks_only, F.array().cast("array<string>"))
    )


def path_stem(path: Column, strict: bool = False) -> Column:
    """File name without folder and without its last ``.json`` and what follows it.

    A path whose last part has no ``.json`` gives ``''``; with ``strict`` it raises.
    """
    last = F.substring_index(path, "/", -1)
    # What follows the last suffix, or all of it where there is none (length then < 0).
    tail = F.substring_index(last, PAGE_SUFFIX, -1)
    length = F.length(last) - F.length(tail) - len(PAGE_SUFFIX)
    stem = F.substring(last, F.lit(1), length)
    if not strict:
        return stem
    return F.when(path.isNull() | last.contains(PAGE_SUFFIX), stem).otherwise(
        F.raise_error(F.concat(F.lit("no .json file name in path: "), path)).cast("string")
    )


def key_label(key: Column) -> Column:
    """The key in parentheses, as a one-field tuple prints."""
    return F.concat(F.lit("("), key.cast("string"), F.lit(")"))
