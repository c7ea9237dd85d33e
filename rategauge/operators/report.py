"""Filtered and sorted reports over averages and deviations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from rategauge.functions import same_text
from rategauge.operators.rank import OVER, UNDER, deviation_order, tie_break, top_k
from rategauge.roles import LISTING, Roles

#: As a group argument: no group filter (fixed value).  ``None`` means the same.
ALL_GROUPS = "ALL"


def _one_group(group: str | None) -> bool:
    return group is not None and group != ALL_GROUPS


def _in_month(df: DataFrame, month: str | None) -> DataFrame:
    return df.filter(F.col("year_month") == month) if month else df


def of_month_and_group(
    df: DataFrame, month: str | None, group: str | None, roles: Roles = LISTING
) -> DataFrame:
    """Rows of the month and of the group (any case); no filter where none is named."""
    chosen = _in_month(df, month)
    return chosen.filter(same_text(F.col(roles.group), group)) if _one_group(group) else chosen


def average_report(
    averages: DataFrame,
    month: str | None = None,
    group: str | None = ALL_GROUPS,
    roles: Roles = LISTING,
) -> DataFrame:
    """``year_month, <group>, avg_price``, dearest first."""
    chosen = of_month_and_group(averages, month, group, roles)
    return chosen.select("year_month", roles.group, "avg_price").orderBy(
        F.desc("avg_price"), "year_month", roles.group
    )


def ranked_report(
    diffs: DataFrame,
    n: int = 10,
    side: str = OVER,
    month: str | None = None,
    group: str | None = ALL_GROUPS,
    roles: Roles = LISTING,
) -> DataFrame:
    """The ``n`` most deviating records, with their ``rank``.

    For all groups: ``n`` per group, ordered by group and rank.  For one group
    (any case): ``n`` in total, found by a bounded sort per task.  ``diffs`` may
    be a full deviation table or a stored top list.
    """
    n = int(n)
    chosen = _in_month(diffs, month)
    if not _one_group(group):
        ranked = top_k(chosen, n, side, roles, keep_rank=True)
        return ranked.orderBy(F.col(roles.group).asc(), F.col("rank").asc())

    chosen = chosen.filter(same_text(F.col(roles.group), group))
    order = [deviation_order(side), *tie_break(chosen, roles)]
    # numbering runs over the n rows that are left; all share one folded name
    window = Window.partitionBy(F.lower(F.col(roles.group))).orderBy(*order)
    best = chosen.orderBy(*order).limit(n)
    return best.withColumn("rank", F.row_number().over(window)).orderBy("rank")


def over_under_report(
    over: DataFrame,
    under: DataFrame,
    n: int = 10,
    month: str | None = None,
    group: str | None = ALL_GROUPS,
    roles: Roles = LISTING,
) -> tuple[DataFrame, DataFrame]:
    """:func:`ranked_report` for both sides, each from its own table."""
    return (
        ranked_report(over, n, OVER, month, group, roles),
        ranked_report(under, n, UNDER, month, group, roles),
    )


def show_report(report: DataFrame, rows: int) -> None:
    """Print at most ``rows`` rows, untruncated; only these reach the driver."""
    report.show(int(rows), truncate=False)
