"""Most over- and under-priced records per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rategauge.roles import LISTING, Roles

OVER = "over"
UNDER = "under"
#: Side of a stored record that stands in both lists.
BOTH = "both"


def check_side(side: str) -> str:
    if side not in (OVER, UNDER):
        raise ValueError(f"side must be {OVER!r} or {UNDER!r}, not {side!r}")
    return side


def of_side(side: str) -> Column:
    """True for a stored record that stands in this side's list."""
    return F.col("side").isin(check_side(side), BOTH)


def tie_break(df: DataFrame, roles: Roles) -> list[Column]:
    """Ascending ids, then what else sets two records apart.

    Ids alone settle ties where they are unique.  The rest makes the order
    total on tables whose ids repeat: records equal in all of it are alike.
    """
    names = [*roles.ids, "year_month", "price_num", roles.date, roles.price]
    present = set(df.columns)
    return [F.col(name).asc_nulls_last() for name in names if name in present]


def deviation_order(side: str) -> Column:
    """Largest deviation first for ``over``, smallest for ``under``; NULL last."""
    pct = F.col("pct_diff")
    return pct.desc_nulls_last() if check_side(side) == OVER else pct.asc_nulls_last()


def top_k(
    diffs: DataFrame,
    k: int,
    side: str = OVER,
    roles: Roles = LISTING,
    partition_by: Sequence[str] | None = None,
    keep_rank: bool = False,
) -> DataFrame:
    """The ``k`` records per group that deviate most to one side.

    ``partition_by`` defaults to the group alone; pass
    ``("year_month", roles.group)`` for one list per month.  The plain
    ``rank <= k`` filter lets Spark cut each task's rows to ``k`` per group
    before the shuffle, which also keeps a hot group small.
    """
    keys = list(partition_by or [roles.group])
    order = [deviation_order(side), *tie_break(diffs, roles)]
    ranked = diffs.withColumn(
        "rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ).filter(F.col("rank") <= int(k))
    return ranked if keep_rank else ranked.drop("rank")


def top_over_under(
    diffs: DataFrame,
    k: int,
    roles: Roles = LISTING,
    partition_by: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(over, under)``, two independent plans.

    Ranking both sides in one window would sort every record twice over, or
    lose the cut before the shuffle; both measured slower than two plans.
    """
    return (
        top_k(diffs, k, OVER, roles, partition_by),
        top_k(diffs, k, UNDER, roles, partition_by),
    )
