"""What a run keeps of its records for the lists: small groups whole, extremes of large ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rategauge.operators.extremes import extreme_prices, fits_whole, whole_records
from rategauge.plans.deviations import BROADCAST_BYTES, NAME_COPIES, ROW_BYTES, measure
from rategauge.roles import LISTING, Roles


def of_groups(
    rows: DataFrame,
    groups: DataFrame,
    keys: list[str],
    how: str,
    roles: Roles = LISTING,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``rows`` whose keys are (``left_semi``) or are not (``left_anti``) in stored ``groups``.

    Groups that fit ``broadcast_bytes`` are broadcast, others merged.
    """
    fits = measure(groups, roles).bytes <= broadcast_bytes
    return _joined(rows, groups, keys, how, fits)


def _joined(rows: DataFrame, groups: DataFrame, keys: list[str], how: str, fits: bool) -> DataFrame:
    groups = groups.select(*keys)
    found = rows.join(F.broadcast(groups) if fits else groups.hint("merge"), keys, how)
    return found.select(*rows.columns)


def summaries(
    clean: DataFrame,
    states: DataFrame,
    k: int,
    keys: list[str],
    roles: Roles = LISTING,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Records of groups that fit whole, and extreme prices of the others.

    ``states`` are the stored counts per ``keys``.

    * All groups fit, or none: nothing is joined.
    * The larger groups fit ``broadcast_bytes``: they are broadcast, and records of the
      smaller ones stay where they lie.
    * They do not: records are merged with the smaller groups.  Those of a group larger
      than a shuffle partition's share go before that, unless its name is too long; AQE
      splits what stays.  The larger groups' extremes are taken before they are merged.
    """
    fits = fits_whole(F.col("listing_count"), k)
    every, large = measure(states, roles), measure(states.filter(~fits), roles)
    if not large.groups:
        return whole_records(clean, k)
    if large.groups == every.groups:
        return extreme_prices(clean, k, keys, roles)
    above = states.filter(~fits)
    if large.bytes <= broadcast_bytes:
        cut, rest = (_joined(clean, above, keys, how, True) for how in ("left_semi", "left_anti"))
        return extreme_prices(cut, k, keys, roles).unionByName(whole_records(rest, k))

    parts = int(clean.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    room = (BROADCAST_BYTES // parts - ROW_BYTES) // NAME_COPIES
    is_hot = (F.col("listing_count") > every.listings // parts) & (F.octet_length(roles.group) <= room)
    cold = _joined(clean, above.filter(is_hot), keys, "left_anti", True)
    whole = _joined(cold, states.filter(fits), keys, "left_semi", False)
    tops = _joined(extreme_prices(clean, k, keys, roles), above, keys, "left_semi", False)
    return tops.unionByName(whole_records(whole, k))
