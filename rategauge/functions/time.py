"""Dates and the month key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, StringType


def as_date(value: Column, dtype: DataType) -> Column:
    """Date, or NULL when the text is not one.  Typed columns are cast directly."""
    if isinstance(dtype, StringType):
        return value.try_cast("date")
    return value.cast("date")


def month_key(day: Column) -> Column:
    """``yyyy-MM``."""
    return F.date_format(day, "yyyy-MM")
