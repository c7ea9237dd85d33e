"""Stored tables, read with their fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rategauge.operators.rank import OVER, UNDER, check_side, of_side
from rategauge.schemas import (
    AVERAGE_CSV,
    AVERAGE_TABLE,
    RANKED_CSV,
    RANKED_TABLE,
)
from rategauge.sources.csv_options import read_options
from rategauge.sources.guards import reading

SIDE = "side"


def _with_partitions(schema: StructType, *names: str) -> StructType:
    """Partition columns are declared text: left to guess, Spark may type them."""
    return StructType([*schema.fields, *(StructField(n, StringType(), True) for n in names)])


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    multi_line: bool = False,
) -> DataFrame:
    """Read Parquet by column name, or CSV with its header checked.

    ``multi_line`` is for fields with line breaks; each file is then one task.
    """
    reader = spark.read.schema(schema)
    with reading(path):
        if fmt == "csv":
            return reader.options(**read_options(multi_line)).csv(path)
        if fmt == "parquet":
            return reader.parquet(path)
    raise ValueError(f"unknown table format {fmt!r}")


def _of_month(df: DataFrame, month: str | None) -> DataFrame:
    return df.filter(F.col("year_month") == month) if month else df


def read_average_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    month: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Average prices with tracking columns, eight columns in fixed order."""
    if fmt == "csv":
        return read_table(spark, path, AVERAGE_CSV, fmt, multi_line)
    table = read_table(spark, path, AVERAGE_TABLE, fmt)
    return _of_month(table, month).select(*AVERAGE_TABLE.names)


def read_ranked_table(
    spark: SparkSession,
    path: str,
    side: str,
    fmt: str = "parquet",
    month: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """One side of the stored top lists, fourteen columns in fixed order."""
    check_side(side)
    if fmt == "csv":
        return read_table(spark, path, RANKED_CSV, fmt, multi_line)
    table = read_table(spark, path, _with_partitions(RANKED_TABLE, SIDE), fmt)
    chosen = _of_month(table.filter(of_side(side)), month)
    return chosen.select(*RANKED_TABLE.names)


def read_over_under_tables(
    spark: SparkSession,
    over_path: str,
    under_path: str | None = None,
    fmt: str = "parquet",
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(over, under)``.  Stored as Parquet, both sides share one path."""
    return (
        read_ranked_table(spark, over_path, OVER, fmt, multi_line=multi_line),
        read_ranked_table(spark, under_path or over_path, UNDER, fmt, multi_line=multi_line),
    )
