"""Column expressions on text that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: A word is a run of anything but blank, tab and the line breaks (fixed by contract).
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole(column: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(text: Column) -> Column:
    """Words in order. A text that begins or ends with a gap gives no empty word."""
    return F.array_remove(F.split(text, GAP, -1), "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())
