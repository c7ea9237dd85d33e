"""Averages and deviations against exact arithmetic, and the join choices."""

from __future__ import annotations

from decimal import ROUND_DOWN, ROUND_HALF_UP, Decimal as D, getcontext
from fractions import Fraction

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rategauge.functions import percent_deviation
from rategauge.operators import average_prices, price_diffs
from rategauge.plans import deviations, join_deviations
from rategauge.plans.deviations import measure
from rategauge.plans.scratch import stored
from tests.helpers import plan, python_free, rows

getcontext().prec = 60
CLEAN = "id string, neighbourhood_cleansed string, price_num decimal(10,2), year_month string"


def half_up(value: Fraction, places: int) -> Fraction:
    """Round a fraction half-up (away from zero) to ``places``."""
    scaled = abs(value) * 10**places
    whole = (2 * scaled.numerator + scaled.denominator) // (2 * scaled.denominator)
    return Fraction(whole if value >= 0 else -whole, 10**places)


def expected_mean(prices: list[D]) -> D:
    mean = sum(map(Fraction, prices)) / len(prices)
    return fraction_to_money(half_up(half_up(mean, 6), 2))


def expected_percent(price: D, average: D) -> D | None:
    quotient = half_up((Fraction(price) - Fraction(average)) / Fraction(average), 13)
    percent = half_up(quotient * 100, 2)
    return None if abs(percent) >= 10**8 else fraction_to_money(percent)


def fraction_to_money(value: Fraction) -> D:
    return (D(value.numerator) / D(value.denominator)).quantize(D("0.01"), ROUND_HALF_UP)


def clean_frame(spark, records):
    return spark.createDataFrame(
        [(str(i), g, D(p), m) for i, (m, g, p) in enumerate(records)], CLEAN
    )


def test_averages_round_half_up(spark):
    df = spark.createDataFrame(
        [("1999-12", "north", 0.01), ("1999-12", "north", 0.02), ("2000-01", "north", 7.0),
         ("2000-01", "south", 10.0), ("2000-01", "south", 10.0), ("2000-01", "south", 10.01)],
        "year_month string, neighbourhood_cleansed string, price_num double",
    )
    averages = average_prices(df)
    assert averages.columns == ["year_month", "neighbourhood_cleansed", "listing_count", "avg_price"]
    assert averages.schema["avg_price"].dataType.simpleString() == "decimal(10,2)"
    assert rows(averages) == [
        ("1999-12", "north", 2, D("0.02")), ("2000-01", "north", 1, D("7.00")), ("2000-01", "south", 3, D("10.00"))]


money = st.integers(1, 9_999_999_999).map(lambda c: D(c) / 100)
small = st.integers(1, 3_000).map(lambda c: D(c) / 100)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(groups=st.lists(st.lists(st.one_of(money, small), min_size=1, max_size=60), min_size=1, max_size=8))
def test_means_are_exact(spark, groups):
    records = [("2025-01", f"g{i}", p) for i, prices in enumerate(groups) for p in prices]
    got = {r.neighbourhood_cleansed: r for r in average_prices(clean_frame(spark, records)).collect()}
    for i, prices in enumerate(groups):
        assert got[f"g{i}"].avg_price == expected_mean(prices)
        assert got[f"g{i}"].listing_count == len(prices)


def test_mean_agrees_with_spark_avg(spark, sf_dir):
    from catalog.queries import _clean

    clean = _clean(spark, sf_dir)
    plain = clean.groupBy("year_month", "neighbourhood_cleansed").agg(
        F.count("*").alias("n"), F.round(F.avg("price_num"), 2).cast("decimal(10,2)").alias("a")
    )
    assert rows(plain) == rows(average_prices(clean))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs=st.lists(st.tuples(st.one_of(money, small), st.one_of(money, small)), min_size=1, max_size=200))
def test_percentages_are_exact(spark, pairs):
    check_percentages(spark, pairs)


def test_percentage_ties_and_bounds(spark):
    limit = D("10000000.00")
    pairs = [
        (D("1.00"), D("1.00")), (D("0.01"), D("99999999.99")), (D("99999999.99"), D("0.01")),
        (D("99999999.99"), limit), (limit, limit - D("0.01")), (limit, limit + D("0.01")),
        (D("9999999.99"), D("9999999.99")), (D("400.02"), D("400.00")), (D("399.98"), D("400.00")),
        (D("1000000.99"), D("1.00")), (D("1000001.00"), D("1.00")), (D("10000.01"), D("0.01")),
    ]
    # a gap of (2m + 1) / 20000 of the average is a tie at the second place
    pairs += [(D(a) + D(a) * (2 * m + 1) / 20000, D(a)) for a in (200, 20000000) for m in range(5)]
    check_percentages(spark, pairs)


def check_percentages(spark, pairs):
    df = spark.createDataFrame(list(enumerate_pairs(pairs)), "i int, p decimal(10,2), a decimal(10,2)")
    got = {r.i: r.x for r in df.select("i", percent_deviation(F.col("p"), F.col("a")).alias("x")).collect()}
    for i, (p, a) in enumerate(pairs):
        assert got[i] == expected_percent(p, a), (p, a)


def enumerate_pairs(pairs):
    for i, (p, a) in enumerate(pairs):
        yield i, p.quantize(D("0.01"), ROUND_DOWN), a


def test_zero_average_gives_no_percentage(spark):
    df = spark.createDataFrame([(D("1.00"), D("0.00"))], "p decimal(10,2), a decimal(10,2)")
    assert df.select(percent_deviation(F.col("p"), F.col("a"))).first()[0] is None


def test_diff_columns_and_types(spark):
    clean = clean_frame(spark, [("2025-01", "a", "10"), ("2025-01", "a", "30")])
    diffs = price_diffs(clean, average_prices(clean))
    assert diffs.columns == [
        "year_month", "neighbourhood_cleansed", "id", "price_num",
        "listing_count", "avg_price", "price_diff", "pct_diff",
    ]
    assert {t for c, t in diffs.dtypes if c.endswith("_diff")} == {"decimal(10,2)"}
    assert rows(diffs, "id", "price_diff", "pct_diff") == [
        ("0", D("-10.00"), D("-50.00")), ("1", D("10.00"), D("50.00")),
    ]


def test_null_keys_drop_out(spark):
    clean = clean_frame(spark, [("2025-01", "a", "10"), (None, "a", "10"), ("2025-01", None, "10")])
    assert rows(price_diffs(clean, average_prices(clean)), "id") == [("0",)]


def skewed(spark):
    """900 of 2700 records in one group, the rest spread over 600."""
    return spark.range(2700).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("g"), (F.col("id") % 600).cast("string"))
        ).alias("neighbourhood_cleansed"),
        ((F.col("id") * 37 % 5000 + 1) / 100).cast("decimal(10,2)").alias("price_num"),
        F.lit("2025-01").alias("year_month"),
    )


def test_all_joins_give_the_same_rows(spark):
    clean = skewed(spark)
    averages = stored(average_prices(clean), "averages")
    want = rows(price_diffs(clean, averages))
    assert len(want) == 2700

    small_enough = join_deviations(clean, averages)
    assert "SortMergeJoin" not in plan(small_enough) and "BroadcastHashJoin" in plan(small_enough)
    assert "Union" not in plan(small_enough)

    split = join_deviations(clean, averages, broadcast_bytes=15_000)
    assert "Union" in plan(split) and "LeftAnti" in plan(split) and "SortMergeJoin" in plan(split)
    assert "ShuffledHashJoin" not in plan(split)

    even = clean.filter("neighbourhood_cleansed <> 'hot'")
    even_averages = stored(average_prices(even), "averages")
    plain = join_deviations(even, even_averages, broadcast_bytes=15_000)
    assert "Union" not in plan(plain) and "SortMergeJoin" in plan(plain)

    hopeless = join_deviations(clean, averages, broadcast_bytes=10)
    for diffs in (small_enough, split, hopeless, deviations(clean)):
        assert rows(diffs) == want
        assert python_free(diffs)
    assert rows(plain) == [r for r in want if r[1] != "hot"]


def test_a_giant_name_leaves_other_hot_groups_split(spark):
    """One name of a megabyte is merged; the other hot group is still broadcast."""
    clean = skewed(spark)
    giant = clean.filter("id < 900").withColumn("neighbourhood_cleansed", F.repeat(F.lit("n"), 1_000_000))
    both = clean.unionByName(giant)
    averages = stored(average_prices(both), "averages")
    diffs = join_deviations(both, averages, broadcast_bytes=50_000)
    assert "Union" in plan(diffs) and "LeftAnti" in plan(diffs)
    assert diffs.count() == 3600


def test_many_hot_groups_are_all_split(spark):
    """30,000 groups above a share: as many as fit the bytes, not a fixed number."""
    spark.conf.set("spark.sql.shuffle.partitions", "60000")
    try:
        clean = spark.range(30_000).selectExpr(
            "cast(id as string) as id", "concat('g', id) as neighbourhood_cleansed",
            "cast(1 as decimal(10,2)) as price_num", "'2025-01' as year_month",
        )
        averages = stored(average_prices(clean.coalesce(1)).coalesce(2), "averages")
        diffs = join_deviations(clean, averages, broadcast_bytes=measure(averages).bytes - 1)
        text = plan(diffs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert "Union" in text and "LeftAnti" in text


def test_sums_never_wrap(spark):
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    most = spark.range(3).selectExpr("9000000000000000000L AS c")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        from rategauge.functions import money

        real, money.cents = money.cents, lambda c: F.col("c")
        try:
            wrong = most.withColumn("p", F.lit(1).cast("decimal(10,2)")).agg(money.exact_mean(F.col("p")))
        finally:
            money.cents = real
        try:
            wrong.collect()
        except Exception as error:
            assert "bigint of cents" in str(error)
        else:
            raise AssertionError("the sum wrapped")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)


def test_filters_before_averages(spark):
    clean = skewed(spark)
    want = rows(deviations(clean).filter("neighbourhood_cleansed = 'hot'"))
    assert rows(deviations(clean, month="2025-01", group="HOT")) == want


def test_empty_input(spark):
    clean = clean_frame(spark, []).limit(0)
    assert average_prices(clean).count() == 0
    assert deviations(clean).count() == 0


def test_partial_aggregation(spark, sf_dir):
    from catalog.queries import avg_price

    text = plan(avg_price(spark, sf_dir))
    assert "partial_try_sum" in text and python_free(avg_price(spark, sf_dir))
