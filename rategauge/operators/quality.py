"""Counts of accepted and rejected records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rategauge.schemas import REJECT_REASONS


def quality_summary(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per reason (NULL for accepted): ``*by, reject_reason, row_count``."""
    return classified.groupBy(*by, "reject_reason").agg(F.count("*").alias("row_count"))


def quality_totals(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per ``by``: rows read, accepted, rejected, and a column per reason.

    One aggregate over the reason column, so counting needs no pass of its own
    over the raw input.
    """
    reason = F.col("reject_reason")
    return classified.groupBy(*by).agg(
        F.count("*").alias("rows_read"),
        F.count_if(reason.isNull()).alias("rows_accepted"),
        F.count_if(reason.isNotNull()).alias("rows_rejected"),
        *(F.count_if(reason == name).alias(name) for name in REJECT_REASONS),
    )
