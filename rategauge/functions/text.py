"""Text tests shared by cleaning and reporting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_blank(text: Column) -> Column:
    """Empty or spaces only.  NULL in, NULL out."""
    return F.trim(text) == ""


def blank_to_null(text: Column) -> Column:
    """NULL for blank text, otherwise the text unchanged."""
    return F.when(is_blank(text), F.lit(None)).otherwise(text)


def same_text(column: Column, value: str) -> Column:
    """Equality regardless of case, folded by the same function on both sides."""
    return F.lower(column) == F.lower(F.lit(value))
