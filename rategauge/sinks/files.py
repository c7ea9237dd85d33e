"""CSV and Parquet sinks that replace what was there."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame

from rategauge.sources.csv_options import write_options


@contextmanager
def writing(path: str, kind: str) -> Iterator[None]:
    try:
        yield
    except Exception as error:
        raise RuntimeError(f"failed to write {kind} to {path}: {error}") from error


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Write CSV with a header, replacing ``path``.

    ``single_file`` is meant for small exports: it sends all rows through one
    task.  The shuffle keeps the work before it parallel.
    """
    out = df.repartition(1) if single_file else df
    with writing(path, "CSV"):
        out.write.mode("overwrite").options(**write_options()).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write Parquet, replacing ``path``."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with writing(path, "Parquet"):
        writer.parquet(path)
    return path
