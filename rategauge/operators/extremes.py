"""Top lists as mergeable summaries: a few extreme prices of each part of the data.

Within one month and group the average is one number, and the percentage is a
function of the price that never falls as the price rises: the gap to the average
grows with the price, and rounding keeps the order.  So whatever the average turns
out to be when more parts come in, the most over-priced records are among the
dearest and the most under-priced among the cheapest, and the ``k`` dearest and
cheapest of every part are enough, up to two exceptions that are told apart:

* Prices that differ may round to one percentage, and then ids decide.  A record
  left out could win by its id only if its percentage is that of the ``k``-th.
* A percentage that does not fit its type is NULL and ranks last, so the dearest
  records may be worth nothing.

Each summary therefore keeps the first record it leaves out, its edge.  All others
left out lie at the edge or beyond.  If the edge's percentage is strictly worse than
that of the ``k``-th record of the merged list, so are theirs, and the list is
exact.  Otherwise the group is named as short and ranked from its records.

A group so small that both sides together would hold each of its records once or
more is kept whole instead: its records stand there once and are neither ranked nor
shuffled.  Where all parts of a group are whole its lists need no summary; and if it
has no more than ``k`` records, both lists are all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rategauge.operators.rank import BOTH, OVER, UNDER, deviation_order, tie_break
from rategauge.roles import LISTING, Roles

SIDES = (OVER, UNDER)
#: Side of the records of a group that is kept whole.
WHOLE = "whole"


def extreme_prices(clean: DataFrame, k: int, by: list[str], roles: Roles = LISTING) -> DataFrame:
    """Per ``by`` the ``k`` dearest and cheapest records and the edge: ``side, place, kept`` in front.

    ``place`` counts from 1; the edge is at ``kept`` + 1.  The plain ``place <= k + 1``
    lets each task cut its rows before the shuffle.
    """
    price, rest = F.col("price_num"), tie_break(clean, roles)
    sides = []
    for side, first in zip(SIDES, (price.desc(), price.asc())):
        place = F.row_number().over(Window.partitionBy(*by).orderBy(first, *rest))
        ranked = clean.withColumn("place", place).filter(F.col("place") <= int(k) + 1)
        sides.append(ranked.select(F.lit(side).alias("side"), "place", F.lit(int(k)).alias("kept"), *clean.columns))
    return sides[0].unionByName(sides[1])


def fits_whole(count: Column, k: int) -> Column:
    """True for a group of ``count`` records that is no longer than both sides with their edges."""
    return count <= 2 * (int(k) + 1)


def whole_records(clean: DataFrame, k: int) -> DataFrame:
    """Records of groups kept whole, in the shape of :func:`extreme_prices`."""
    return clean.select(F.lit(WHOLE).alias("side"), F.lit(0).alias("place"), F.lit(int(k)).alias("kept"), *clean.columns)


def on_sides(extremes: DataFrame) -> DataFrame:
    """The records kept whole as rows of either side, next to the rows of groups that are not."""
    sides = F.when(F.col("side") == WHOLE, F.array(*map(F.lit, SIDES))).otherwise(F.array("side"))
    return extremes.withColumn("side", F.explode(sides))


def whole_lists(diffs: DataFrame, k: int, keys: list[str], roles: Roles = LISTING) -> DataFrame:
    """Lists of groups all of whose records are here, with ``side`` saying in which of them a record stands.

    Only groups of more than ``k`` records are ranked.
    """
    few = diffs.filter(F.col("listing_count") <= int(k)).withColumn("side", F.lit(BOTH))
    many = diffs.filter(F.col("listing_count") > int(k))
    for side in SIDES:
        order = Window.partitionBy(*keys[::-1]).orderBy(deviation_order(side), *tie_break(diffs, roles))
        many = many.withColumn(f"place_{side}", F.row_number().over(order))
    over, under = (F.col(f"place_{side}") <= int(k) for side in SIDES)
    side = F.when(over & under, BOTH).when(over, OVER).when(under, UNDER)
    many = many.withColumn("side", side).filter(over | under)
    return few.unionByName(many.select(*few.columns)).drop("place", "kept")


def _worse() -> Column:
    """Grows from the best to the worst of a side; NULL, the last, as in the ranking."""
    pct = F.col("pct_diff")
    return F.when(F.col("side") == OVER, -pct).otherwise(pct)


def merged_lists(extremes: DataFrame, k: int, keys: list[str], roles: Roles = LISTING) -> tuple[DataFrame, DataFrame]:
    """``(lists, short)`` from summaries of all parts that carry their deviations.

    ``lists`` holds up to ``k`` records per side and ``keys``; of the ``keys`` in ``short`` they
    may be wrong.  ``extremes`` is read twice; store it.
    """
    rows = extremes.withColumn("worse", _worse())
    by = ["side", *keys]
    order = Window.partitionBy(*by).orderBy(F.col("worse").asc_nulls_last(), *tie_break(extremes, roles))
    lists = rows.filter(F.col("place") <= F.col("kept")).withColumn("final", F.row_number().over(order))
    lists = lists.filter(F.col("final") <= int(k))
    last = lists.filter(F.col("final") == int(k)).select(*(F.col(c).alias(f"k_{c}") for c in by), F.col("worse").alias("last"))
    edges = rows.filter(F.col("place") > F.col("kept")).groupBy(*by).agg(
        F.min("worse").alias("nearest"), F.count_if(F.col("worse").isNull()).alias("unknown")
    )
    same = [F.col(c) == F.col(f"k_{c}") for c in by]
    safe = (F.col("unknown") == 0) & (F.col("nearest") > F.col("last"))
    short = edges.join(last, same, "left").filter(~F.coalesce(safe, F.lit(False))).select(*keys).distinct()
    return lists.drop("worse", "final", "place", "kept"), short
