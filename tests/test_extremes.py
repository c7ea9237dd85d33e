"""Merged lists of extremes against the full ranking, on many small groups at once."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rategauge.operators import average_prices, price_diffs
from rategauge.operators.extremes import extreme_prices, merged_lists
from rategauge.operators.rank import OVER, UNDER, top_k
from tests.helpers import plan, rows

KEYS = ["year_month", "neighbourhood_cleansed"]


def prices(kind, rng, n):
    if kind == "spread":
        return [rng.randint(1, 10**6) for _ in range(n)]
    if kind == "ties":  # few prices, and close ones that round to one percentage
        base = rng.choice([100, 5_000_000, 999_999_000])
        return [base + rng.randint(0, 3) for _ in range(n)]
    return [rng.choice([1, 2, 10**10 - 1, 10**10 - 2, rng.randint(1, 10**10 - 1)]) for _ in range(n)]  # NULL percentages


@pytest.mark.parametrize("k", [1, 3])
@pytest.mark.parametrize("kept", [1, 3, 4])
def test_merged_lists(spark, k, kept):
    rng = random.Random(k * 10 + kept)
    records = []
    for group in range(240):
        kind = ("spread", "ties", "lost")[group % 3]
        for cents in prices(kind, rng, rng.randint(1, 12)):
            records.append((rng.randint(1, 10**6), f"g{group}", cents, "2025-01", rng.randint(0, 2)))
    frame = spark.createDataFrame(records, "id int, neighbourhood_cleansed string, cents long, year_month string, part int")
    clean = frame.selectExpr(
        "lpad(cast(id AS string), 7, '0') AS id", "neighbourhood_cleansed", "cast(cents AS string) AS price", "'d' AS last_scraped",
        "cast(cents / 100 AS decimal(10,2)) AS price_num", "year_month", "part",
    ).cache()
    averages = average_prices(clean)
    extremes = price_diffs(extreme_prices(clean, kept, ["part", *KEYS]), averages)
    lists, short = merged_lists(extremes, k, KEYS)
    bad = {tuple(r) for r in short.collect()}
    names = [*KEYS, "id", "price_num"]
    diffs = price_diffs(clean, averages)
    for side in (OVER, UNDER):
        want = [r for r in rows(top_k(diffs, k, side, partition_by=KEYS), *names) if r[:2] not in bad]
        assert [r for r in rows(lists.filter(F.col("side") == side), *names) if r[:2] not in bad] == want
    spread = {("2025-01", f"g{g}") for g in range(0, 240, 3)}
    if kept >= k:
        assert not bad & spread  # what the summaries are for
    assert len(bad) < 240


def test_extremes_are_cut_before_the_shuffle(spark):
    clean = spark.createDataFrame([("1", "g", "1", "d", "2025-01")], "id string, neighbourhood_cleansed string, price string, last_scraped string, year_month string")
    clean = clean.withColumn("price_num", F.lit(1).cast("decimal(10,2)"))
    assert plan(extreme_prices(clean, 3, KEYS)).count("WindowGroupLimit") >= 4
