"""Deviations from the group average at any group count and any skew."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rategauge.operators.metrics import average_prices, price_diffs
from rategauge.operators.report import of_month_and_group
from rategauge.plans.scratch import stored
from rategauge.roles import LISTING, Roles

#: Largest table sent whole to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024

#: Memory of one average row in a hash table, less its group name; rounded up.
ROW_BYTES = 192

#: A hash table holds the name twice, in the key and in the row.
NAME_COPIES = 2


@dataclass(frozen=True)
class AverageSize:
    """What one small aggregate over the stored averages tells about them."""

    groups: int
    listings: int
    largest_group: int
    name_bytes: int

    @property
    def bytes(self) -> int:
        return self.groups * ROW_BYTES + NAME_COPIES * self.name_bytes


def _row_bytes(roles: Roles) -> Column:
    return NAME_COPIES * F.coalesce(_name_bytes(roles), F.lit(0)) + ROW_BYTES


def _name_bytes(roles: Roles) -> Column:
    return F.octet_length(F.col(roles.group).cast("string")).cast("bigint")


def measure(averages: DataFrame, roles: Roles = LISTING) -> AverageSize:
    """Size of an average table; cheap on a stored one."""
    name = _name_bytes(roles)
    zero = F.lit(0)
    row = averages.agg(
        F.count("*").alias("groups"),
        F.coalesce(F.sum("listing_count"), zero).alias("listings"),
        F.coalesce(F.max("listing_count"), zero).alias("largest_group"),
        F.coalesce(F.sum(name), zero).alias("name_bytes"),
    ).first()
    return AverageSize(**row.asDict())


def join_deviations(
    clean: DataFrame,
    averages: DataFrame,
    roles: Roles = LISTING,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """:func:`~rategauge.operators.metrics.price_diffs` with a checked join.

    ``averages`` should be stored: it is measured first.

    * Fits ``broadcast_bytes``: it is broadcast, and the records are neither
      shuffled nor sorted.
    * Does not fit, and no group is larger than one shuffle partition's share of
      the records: both sides are shuffled and merged.
    * Does not fit, and some groups are larger: these are measured and broadcast,
      the rest is merged.  Fewer groups than shuffle partitions can be that
      large.  Should their names not fit the bound together, those with names
      longer than an equal share of it are merged as well, where AQE splits
      them.  No record is left out either way.
    """
    # further columns would escape the measured size
    averages = averages.select("year_month", roles.group, "listing_count", "avg_price")
    size = measure(averages, roles)
    if size.bytes <= broadcast_bytes:
        return price_diffs(clean, F.broadcast(averages), roles)

    share = size.listings // int(clean.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if size.largest_group <= share:
        return price_diffs(clean, averages.hint("merge"), roles)

    is_hot = F.col("listing_count") > share
    total, count = averages.filter(is_hot).agg(F.sum(_row_bytes(roles)), F.count("*")).first()
    if total > broadcast_bytes:
        is_hot &= _row_bytes(roles) <= broadcast_bytes // count
    hot, cold = averages.filter(is_hot), averages.filter(~is_hot)
    keys = ["year_month", roles.group]
    rest = clean.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return price_diffs(clean, F.broadcast(hot), roles).unionByName(
        price_diffs(rest, cold.hint("merge"), roles)
    )


def deviations(
    clean: DataFrame,
    roles: Roles = LISTING,
    broadcast_bytes: int = BROADCAST_BYTES,
    month: str | None = None,
    group: str | None = None,
) -> DataFrame:
    """Averages and deviations of ``clean`` in one call, of one month or group if named.

    An average belongs to a month and a group, so both are filtered before it is
    taken.  The averages are computed and stored first.  Left in one plan with
    the join, the records would be shuffled by group before the size of the
    averages is known, and a hot group would end up in one task.
    """
    clean = of_month_and_group(clean, month, group, roles)
    averages = stored(average_prices(clean, roles), "averages")
    return join_deviations(clean, averages, roles, broadcast_bytes)
