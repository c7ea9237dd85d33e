from __future__ import annotations

from pyspark.sql import DataFrame


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows as sorted tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def ordered(df: DataFrame, *columns: str) -> list[tuple]:
    chosen = df.select(*columns) if columns else df
    return [tuple(r) for r in chosen.collect()]


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def python_free(df: DataFrame) -> bool:
    text = plan(df)
    return not any(word in text for word in ("Python", "Pandas", "Arrow"))
