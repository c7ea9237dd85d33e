"""Month-partitioned Parquet tables whose months can be rewritten."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from rategauge.sinks.files import writing


def overwrite_partition(
    df: DataFrame,
    table: str,
    column: str,
    value: str,
    partition_by: Sequence[str] = (),
) -> str:
    """Replace ``<table>/<column>=<value>`` by ``df``, and nothing else.

    The directory is addressed by path, so it is replaced even when ``df`` is
    empty or lacks some of the sub-partitions it had before.
    """
    path = f"{table.rstrip('/')}/{column}={value}"
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with writing(path, "Parquet"):
        writer.parquet(path)
    return path


def overwrite_months(
    df: DataFrame, table: str, months: Iterable[str], column: str = "year_month"
) -> str:
    """Replace the given months of a table partitioned by ``column``.

    Rows of other months are not written.  Dynamic overwrite replaces the months
    that have rows, in one job; a month that has none would keep its old
    directory, so it is replaced by an empty one.  ``rebalance`` gathers each
    month into few files and splits a month too large for one.

    ``df`` is read twice, once for its month column alone, so store it first if
    it is costly to compute.
    """
    wanted = sorted(set(months))
    rows = df.filter(F.col(column).isin(wanted))
    # at most one row per wanted month comes back
    filled = {row[0] for row in rows.select(column).distinct().collect()}
    if filled:
        with writing(table, "Parquet"):
            (
                rows.hint("rebalance", F.col(column))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(column)
                .parquet(table)
            )
    for month in wanted:
        if month not in filled:
            overwrite_partition(df.drop(column).limit(0), table, column, month)
    return table
