"""Cleaning: derived columns, one reject reason per record, the two-way split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from rategauge.functions import (
    as_date,
    blank_to_null,
    has_positive_price,
    is_blank,
    month_key,
    parse_price,
)
from rategauge.roles import LISTING, Roles


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, StringType)


def _absent(df: DataFrame, name: str) -> Column:
    """NULL, or blank where the column is text.  Never NULL itself."""
    column = F.col(name)
    if _is_text(df, name):
        return F.coalesce(is_blank(column), F.lit(True))
    return column.isNull()


def _day(df: DataFrame, roles: Roles) -> Column:
    return as_date(F.col(roles.date), df.schema[roles.date].dataType)


def usable(df: DataFrame, roles: Roles = LISTING) -> Column:
    """True for a record without a reject reason; false or NULL for the others.

    Says the same as ``reject_reason IS NULL`` in three tests instead of seven:
    an absent or unreadable price is not positive, an absent date is no date.
    On typed columns the tests reach the Parquet scan.
    """
    date = F.col(roles.date)
    dated = _day(df, roles).isNotNull() if _is_text(df, roles.date) else date.isNotNull()
    price = has_positive_price(F.col(roles.price), df.schema[roles.price].dataType)
    return price & dated & ~_absent(df, roles.group)


def prepare(df: DataFrame, roles: Roles = LISTING) -> DataFrame:
    """Add ``price_num`` and ``year_month``; turn blank dates into NULL."""
    date = F.col(roles.date)
    cleaned = blank_to_null(date) if _is_text(df, roles.date) else date
    return df.select(
        *(cleaned.alias(name) if name == roles.date else F.col(name) for name in df.columns),
        parse_price(F.col(roles.price), df.schema[roles.price].dataType).alias("price_num"),
        month_key(_day(df, roles)).alias("year_month"),
    )


def classify(df: DataFrame, roles: Roles = LISTING) -> DataFrame:
    """:func:`prepare` plus ``reject_reason``, NULL for an accepted record.

    Every record gets exactly one verdict, so accepted and rejected records
    always add up to the input.
    """
    prepared = prepare(df, roles)
    number = F.col("price_num")
    reason = (
        F.when(_absent(df, roles.price), "missing_price")
        .when(number.isNull(), "bad_price")
        .when(number == 0, "zero_price")
        .when(number < 0, "negative_price")
        # blank dates are NULL by now; a date without a month is unreadable
        .when(F.col(roles.date).isNull(), "missing_date")
        .when(F.col("year_month").isNull(), "bad_date")
        .when(_absent(df, roles.group), "missing_group")
    )
    return prepared.select("*", reason.alias("reject_reason"))


def accepted(df: DataFrame, roles: Roles = LISTING) -> DataFrame:
    """Records without a reject reason, prepared.

    Their month is never NULL.  The coalesce says so to Catalyst, which would
    otherwise format every date a second time to test a join key for NULL.
    """
    month = F.coalesce(F.col("year_month"), F.lit(""))
    return prepare(df.filter(usable(df, roles)), roles).withColumn("year_month", month)


def rejected(df: DataFrame, roles: Roles = LISTING) -> DataFrame:
    """Records with a reject reason, prepared, with the reason."""
    unusable = ~F.coalesce(usable(df, roles), F.lit(False))
    return classify(df.filter(unusable), roles)


def split(df: DataFrame, roles: Roles = LISTING) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)``: disjoint, and together the whole input.

    Each side scans ``df`` once.  Where the input is costly to read (CSV, a
    join), store :func:`classify`'s result and filter that, as
    :func:`rategauge.plans.monthly.run_month` does.
    """
    return accepted(df, roles), rejected(df, roles)
