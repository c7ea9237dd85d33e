"""Columns that say where a record came from and which run produced it."""

from __future__ import annotations

import posixpath
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F


def file_name_column() -> Column:
    """Name of the file each row was read from, for reads of many files."""
    return F.col("_metadata.file_name")


def add_tracking(
    df: DataFrame,
    source: str | Column,
    run_name: str,
    run_type: str = "scheduled",
    processed_at: datetime | None = None,
) -> DataFrame:
    """Append the four tracking columns.

    ``source`` is a path, of which the last part is kept, or a column.  Pass one
    ``processed_at`` to all outputs of a run, so that they agree; without it the
    time is taken when each output runs.
    """
    origin = F.lit(posixpath.basename(source)) if isinstance(source, str) else source
    moment = F.current_timestamp() if processed_at is None else F.lit(processed_at)
    return df.withColumns(
        {
            "processing_timestamp": moment.cast("timestamp"),
            "source_file": origin,
            "run_type": F.lit(run_type),
            "final_log_file_name": F.lit(run_name),
        }
    )
