"""Reports over published tables, or over their CSV exports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rategauge.operators.rank import OVER, UNDER, deviation_order, tie_break
from rategauge.operators.report import (
    ALL_GROUPS,
    average_report,
    of_month_and_group,
    over_under_report,
    ranked_report,
    show_report,
)
from rategauge.plans.deviations import join_deviations
from rategauge.plans.monthly import records_of
from rategauge.plans.scratch import stored
from rategauge.plans.store import REJECTED, Store
from rategauge.sinks.files import write_csv
from rategauge.sources.tables import read_average_table, read_over_under_tables

#: Rows printed per report (fixed values).
AVERAGE_ROWS = 10
RANKED_ROWS = 50


@dataclass(frozen=True)
class Reports:
    average: DataFrame
    over: DataFrame
    under: DataFrame

    def show(self, average_rows: int = AVERAGE_ROWS, ranked_rows: int = RANKED_ROWS) -> None:
        show_report(self.average, average_rows)
        show_report(self.over, ranked_rows)
        show_report(self.under, ranked_rows)


def _short(lists: DataFrame, store: Store, n: int, side: str, group: str | None) -> DataFrame:
    """``(year_month, <group>)`` whose stored list is full and all of it within the first ``n``.

    Only these can hold further records that belong in the report: in a list that
    is not full nothing was left out, and what was left out of another comes after
    its last record, which is not among the first ``n`` itself.
    """
    roles = store.roles
    one = group is not None and group != ALL_GROUPS
    whole = F.lower(F.col(roles.group)) if one else F.col(roles.group)
    order = Window.partitionBy(whole).orderBy(deviation_order(side), *tie_break(lists, roles))
    # an exact cut: list rows beyond the first n cannot be the last of a short list
    ranked = lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    held = F.create_map(*(F.lit(x) for pair in store.manifest.top_k.items() for x in pair))
    sizes = ranked.groupBy("year_month", roles.group).agg(F.count("*").alias("size"))
    return sizes.filter(F.col("size") >= held[F.col("year_month")]).select("year_month", roles.group)


def _side(store: Store, side: str, month: str | None, group: str | None, n: int) -> DataFrame:
    """Rows enough for a report of ``n``: the stored lists, and records of the groups they are too short for."""
    roles, lists = store.roles, store.ranked(side, month)
    held = [k for m, k in store.manifest.top_k.items() if month in (None, m)]
    if not held or n <= min(held):
        return lists
    lists = of_month_and_group(lists, month, group, roles)
    short = stored(_short(lists, store, n, side, group), "short")
    months = {row[0] for row in short.select("year_month").distinct().collect()}
    if not months:
        return lists
    averages = store.averages(month).select("year_month", roles.group, "listing_count", "avg_price")
    averages = averages.join(short, ["year_month", roles.group], "left_semi")
    deep = join_deviations(records_of(store, short, months), stored(averages, "averages"), roles)
    rest = lists.join(short, ["year_month", roles.group], "left_anti")
    names = [c for c in lists.columns if c in deep.columns]
    return rest.select(*names).unionByName(deep.select(*names))


def run_reports(
    spark: SparkSession,
    root: str,
    month: str | None = None,
    group: str | None = ALL_GROUPS,
    n: int = 10,
) -> Reports:
    """The three reports over the tables below ``root``, for any ``n``.

    Up to the stored length lists alone are read; beyond it also the records of
    those months and groups whose lists are too short.
    """
    store = Store.open(spark, root)
    over, under = (ranked_report(_side(store, s, month, group, n), n, s, month, group, store.roles) for s in (OVER, UNDER))
    return Reports(average_report(store.averages(month), month, group, store.roles), over, under)


# -- the CSV exchange between the two jobs ------------------------------------------


def export_csv(spark: SparkSession, root: str, path: str, month: str | None = None) -> str:
    """Published tables as CSV below ``path``: averages and both lists of a data month (or of
    all), rejected records of the run month of that name."""
    store = Store.open(spark, root)
    write_csv(store.averages(month), f"{path}/avg_price")
    write_csv(store.ranked(OVER, month), f"{path}/top_over_priced")
    write_csv(store.ranked(UNDER, month), f"{path}/top_under_priced")
    write_csv(store.classified(REJECTED, run_month=month), f"{path}/errors")
    return path


def csv_reports(
    spark: SparkSession,
    path: str,
    month: str | None = None,
    group: str | None = ALL_GROUPS,
    n: int = 10,
    multi_line: bool = False,
) -> Reports:
    """The three reports over an export of listings; lists are as long as they were stored."""
    over, under = read_over_under_tables(
        spark, f"{path}/top_over_priced", f"{path}/top_under_priced", "csv", multi_line
    )
    averages = read_average_table(spark, f"{path}/avg_price", "csv", multi_line=multi_line)
    return Reports(average_report(averages, month, group), *over_under_report(over, under, n, month, group))
