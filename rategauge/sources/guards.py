"""Checks on inputs and one place that maps Spark's read errors."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame


@contextmanager
def reading(path: str) -> Iterator[None]:
    """Turn a missing path into ``FileNotFoundError``, the rest into ``RuntimeError``.

    Spark checks the path on whatever file system it names, so this holds for
    object stores and HDFS as well as for local files.
    """
    try:
        yield
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"input path not found: {path}") from error
        raise RuntimeError(f"failed to read {path}: {error}") from error
    except Exception as error:
        raise RuntimeError(f"failed to read {path}: {error}") from error


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """``df`` itself, or ``ValueError`` if it has no row.  Looks for one row only."""
    if df.isEmpty():
        raise ValueError(f"no data found in {what}: check the path and the filters")
    return df
