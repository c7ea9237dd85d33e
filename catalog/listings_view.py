"""The listings view: one raw listing record per order, a known share of it dirty.

The spoiled values and the divisors that place them are fixed values, given in
FIXTURES.md section C and mirrored by ``oracles.LISTINGS_SQL``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rategauge.roles import LISTING

SPOILED_GROUP = {31: "", 37: "   ", 41: None}
SPOILED_PRICE = {17: None, 19: "", 23: "   ", 29: "$0.00", 43: "-$5.00", 47: "N/A"}
SPOILED_DATE = {53: None, 59: " ", 61: "garbage"}


def _spoil(key: Column, spoiled: dict[int, str | None], value: Column) -> Column:
    """``value``, unless a divisor of ``key`` names another; the first one wins."""
    (first, text), *rest = spoiled.items()
    chain = F.when(key % first == 0, F.lit(text))
    for divisor, text in rest:
        chain = chain.when(key % divisor == 0, F.lit(text))
    return chain.otherwise(value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("o_orderkey")
    price = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    day = F.col("o_orderdate").cast("date").cast("string")
    return joined.select(
        key.cast("string").alias(LISTING.ids[0]),
        _spoil(key, SPOILED_GROUP, F.col("n_name")).alias(LISTING.group),
        _spoil(key, SPOILED_PRICE, price).alias(LISTING.price),
        _spoil(key, SPOILED_DATE, day).alias(LISTING.date),
    )
