"""Average price per month and group, and each record's deviation from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rategauge.functions import amount_deviation, exact_mean, percent_deviation
from rategauge.roles import LISTING, Roles
from rategauge.schemas import MONEY_DDL


def average_prices(clean: DataFrame, roles: Roles = LISTING) -> DataFrame:
    """``year_month, <group>, listing_count, avg_price``.

    Partial sums are taken before the shuffle, so a hot group costs one small
    row per task, whatever its share of the input.
    """
    return clean.groupBy("year_month", roles.group).agg(
        F.count("*").alias("listing_count"),
        exact_mean(F.col("price_num").cast(MONEY_DDL)).alias("avg_price"),
    )


def with_deviation(joined: DataFrame) -> DataFrame:
    """Add ``price_diff`` and ``pct_diff`` to records that carry their average."""
    price, average = F.col("price_num").cast(MONEY_DDL), F.col("avg_price").cast(MONEY_DDL)
    return joined.select(
        "*",
        amount_deviation(price, average).alias("price_diff"),
        percent_deviation(price, average).alias("pct_diff"),
    )


def price_diffs(clean: DataFrame, averages: DataFrame, roles: Roles = LISTING) -> DataFrame:
    """Join records to their average; keys come first, NULL keys drop out.

    A plain equi-join.  With ``averages`` read from a stored table Catalyst
    knows its size and picks the join.  Where ``averages`` is still an
    unexecuted aggregate, prefer :func:`rategauge.plans.deviations.deviations`,
    which checks the size first and keeps hot groups apart.  The group is the first
    key: where both sides are sorted it tells more rows apart than the month.
    """
    keys = ["year_month", roles.group]
    joined = clean.join(averages, keys[::-1], "inner")
    return with_deviation(joined.select(*keys, *(c for c in joined.columns if c not in keys)))
