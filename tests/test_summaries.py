"""Small groups kept whole, large ones by their extremes, and lists of both."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rategauge.operators import average_prices, price_diffs
from rategauge.operators.extremes import WHOLE, extreme_prices, whole_lists, whole_records
from rategauge.operators.rank import BOTH, OVER, UNDER, of_side, top_k
from rategauge.plans import MonthlyRun, run_month, run_months
from rategauge.plans.store import ACCEPTED
from rategauge.plans.summaries import of_groups, summaries
from tests.helpers import plan, rows

GROUP = "neighbourhood_cleansed"
KEYS = ["year_month", GROUP]
K = 2


def records(rng, group, n):
    """Close prices that round to one percentage, prices that give none, and others."""
    kinds = ([10_000, 10_001, 10_002], [1, 10**10 - 1, 10**10 - 2], [rng.randint(1, 10**6) for _ in range(n)])
    kind = rng.choice(kinds)
    return [(f"{rng.randint(1, 10**6):07d}", group, rng.choice(kind), f"2025-0{rng.randint(1, 2)}-03") for _ in range(n)]


def source(folder, month, lines):
    path = folder / f"listings_{month}.csv"
    head = "id,neighbourhood_cleansed,price,last_scraped\n"
    path.write_text(head + "".join(f"{i},{g},{c // 100}.{c % 100:02d},{day}\n" for i, g, c, day in lines))
    return str(path)


def clean_of(spark, lines):
    frame = spark.createDataFrame(lines, f"id string, {GROUP} string, cents long, last_scraped string")
    return frame.select(
        F.lit("2025-01").alias("run_month"), "id", GROUP, F.col("cents").cast("string").alias("price"), "last_scraped",
        (F.col("cents") / 100).cast("decimal(10,2)").alias("price_num"), F.substring("last_scraped", 1, 7).alias("year_month"),
    )


@pytest.mark.parametrize("sizes", [(1, 6), (1, 12), (5, 20), (40, 50)], ids=["small", "most small", "most large", "large"])
def test_lists_of_runs_equal_the_ranking_of_all_records(spark, tmp_path, sizes):
    """Of two runs; in the mixed cases the same group is whole in one and cut in the other."""
    rng = random.Random(sizes[1])
    for month in ("2025-01", "2025-02"):
        lines = [r for g in range(40) for r in records(rng, f"g{g}", rng.randint(*sizes))]
        path = source(tmp_path, month, lines)
        store = run_month(spark, MonthlyRun(month, path, str(tmp_path / "out"), "b", top_k=K))
        clean = store.classified(ACCEPTED).select("id", GROUP, "price", "last_scraped", "price_num", "year_month").cache()
        diffs = price_diffs(clean, average_prices(clean))
        names = [*KEYS, "id", "price_num", "listing_count", "avg_price", "price_diff", "pct_diff"]
        for side in (OVER, UNDER):
            assert rows(store.ranked(side), *names) == rows(top_k(diffs, K, side, partition_by=KEYS), *names)


def test_small_groups_are_kept_once(spark, tmp_path):
    """Both sides held every record before: twice in the extremes, twice in the lists."""
    lines = [(f"{g}{i}", f"g{g}", 100 * (g + i + 1), "2025-01-03") for g in range(5) for i in range(K)]
    lines += [(f"9{i}", "large", 100 + i, "2025-01-03") for i in range(2 * K + 3)]
    store = run_month(spark, MonthlyRun("2025-01", source(tmp_path, "2025-01", lines), str(tmp_path / "out"), "b", top_k=K))
    kept = store.extremes({"2025-01"})
    assert rows(kept.filter(F.col("side") == WHOLE), "id") == sorted((r[0],) for r in lines if r[1] != "large")
    assert rows(kept.filter(F.col(GROUP) == "large"), "side", "place") == sorted((s, p) for s in (OVER, UNDER) for p in range(1, K + 2))
    lists = spark.read.parquet(f"{store.root}/top_priced")
    assert lists.count() == 5 * K + 2 * K
    assert rows(lists.groupBy("side").count()) == [(BOTH, 5 * K), (OVER, K), (UNDER, K)]


@pytest.mark.parametrize("k", [1, 3])
def test_whole_lists(spark, k):
    rng = random.Random(k)
    clean = clean_of(spark, [r for g in range(90) for r in records(rng, f"g{g}", rng.randint(1, 9))]).cache()
    diffs = price_diffs(clean, average_prices(clean))
    lists = whole_lists(price_diffs(whole_records(clean, k), average_prices(clean)), k, KEYS)
    names = [*KEYS, "id", "price_num", "pct_diff"]
    for side in (OVER, UNDER):
        assert rows(lists.filter(of_side(side)), *names) == rows(top_k(diffs, k, side, partition_by=KEYS), *names)


def test_summaries_are_the_same_however_they_are_joined(spark, tmp_path):
    rng = random.Random(5)
    keys = ["run_month", *KEYS]
    lines = [r for g in range(60) for r in records(rng, f"g{g}", rng.randint(1, 30))] + records(rng, "hot", 900)
    clean = clean_of(spark, lines).cache()
    states = clean.groupBy(*keys).agg(F.count("*").alias("listing_count")).cache()
    few, many = summaries(clean, states, K, keys), summaries(clean, states, K, keys, broadcast_bytes=0)
    assert rows(few) == rows(many)
    small = states.filter(F.col("listing_count") <= 2 * (K + 1)).select(*keys)
    want = extreme_prices(clean.join(small, keys, "left_anti").select(*clean.columns), K, keys)
    assert rows(few.filter(F.col("side") != WHOLE), *want.columns) == rows(want)
    assert rows(few.filter(F.col("side") == WHOLE), *clean.columns) == rows(clean.join(small, keys, "left_semi"), *clean.columns)
    # what is not joined is not shuffled
    assert "Exchange" not in plan(summaries(clean.join(small, keys, "left_semi"), states.join(small, keys), K, keys).select("id")).split("InMemoryTableScan")[0]
    assert plan(of_groups(clean, states, keys, "left_semi", broadcast_bytes=0)).count("SortMergeJoin") == 1


def test_a_run_reads_files_larger_and_smaller_than_a_split(spark, tmp_path):
    """Larger ones are read in blocks, smaller ones whole; both tell their names."""
    source(tmp_path, "2025-01", [(f"{i}", "g", 100, "2025-01-03") for i in range(2000)])
    source(tmp_path, "2025-02", [("x", "g", 100, "2025-02-03")])
    split = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(split)
    spark.conf.set(split, "4096")
    try:
        store = run_months(spark, ["2025-01", "2025-02"], str(tmp_path), str(tmp_path / "out"), "b", top_k=K)
        found = store.audit().select("month", "source_file", "rows_accepted")
    finally:
        spark.conf.set(split, before)
    assert rows(found) == [("2025-01", "listings_2025-01.csv", 2000), ("2025-02", "listings_2025-02.csv", 1)]
