"""Cleaning: a small example, every edge row, and the split's invariants."""

from __future__ import annotations

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from rategauge.operators import accepted, classify, prepare, rejected, split
from rategauge.roles import LISTING, Roles
from tests.helpers import python_free, rows

SCHEMA = "id string, neighbourhood_cleansed string, price string, last_scraped string"
DAY = "2025-10-01"


def one(spark, price="$10.00", day=DAY, group="Soho"):
    return spark.createDataFrame([("1", group, price, day)], SCHEMA)


def verdict(df):
    return classify(df).first()


def test_split_on_other_columns(spark):
    data = [("p1", "west", "12", DAY), ("p2", "   ", "7.5", DAY), ("p3", "west", "free", DAY), ("p4", "east", "3", "soon")]
    df = spark.createDataFrame(data, "plot string, ward string, rent string, seen string")
    clean, errors = split(df, Roles(("plot",), "ward", "rent", "seen"))
    assert rows(clean) == [("p1", "west", "12", DAY, D("12.00"), "2025-10")]
    assert clean.schema["price_num"].dataType.simpleString() == "decimal(10,2)"
    assert rows(errors, "plot", "reject_reason") == [
        ("p2", "missing_group"), ("p3", "bad_price"), ("p4", "bad_date")]


@pytest.mark.parametrize(
    "price, number",
    [
        (" 100 ", "100.00"),
        ("1e3", "1000.00"),
        ("100.005", "100.01"),
        ("$1,234.50", "1234.50"),
        ("99999999.99", "99999999.99"),
        ("$$1,,0", "10.00"),
    ],
)
def test_readable_prices(spark, price, number):
    row = verdict(one(spark, price=price))
    assert (row.price_num, row.reject_reason) == (D(number), None)


@pytest.mark.parametrize(
    "price, reason",
    [
        (None, "missing_price"),
        ("", "missing_price"),
        ("   ", "missing_price"),
        ("N/A", "bad_price"),
        ("£5", "bad_price"),
        ("$", "bad_price"),
        ("\t", "bad_price"),
        ("123456789.00", "bad_price"),
        ("99999999.995", "bad_price"),
        ("$0.00", "zero_price"),
        ("0.004", "zero_price"),
        ("-$5.00", "negative_price"),
    ],
)
def test_rejected_prices(spark, price, reason):
    df = one(spark, price=price)
    assert verdict(df).reject_reason == reason
    assert accepted(df).count() == 0
    assert rows(rejected(df), "reject_reason") == [(reason,)]


@pytest.mark.parametrize(
    "day, reason, month",
    [
        (None, "missing_date", None),
        ("", "missing_date", None),
        (" ", "missing_date", None),
        ("garbage", "bad_date", None),
        ("01/10/2025", "bad_date", None),
        ("2025-13-01", "bad_date", None),
        ("2025-10", None, "2025-10"),
        ("2025-10-01 12:30:00", None, "2025-10"),
    ],
)
def test_dates(spark, day, reason, month):
    df = one(spark, day=day)
    row = verdict(df)
    assert (row.reject_reason, row.year_month) == (reason, month)
    assert accepted(df).count() == (1 if reason is None else 0)
    if reason == "missing_date":
        assert row.last_scraped is None
    else:
        assert row.last_scraped == day


@pytest.mark.parametrize("group", [None, "", "   "])
def test_missing_group(spark, group):
    df = one(spark, group=group)
    assert verdict(df).reject_reason == "missing_group"
    assert accepted(df).count() == 0
    assert rejected(df).count() == 1


def test_first_reason_wins(spark):
    cases = [
        (("", "", ""), "missing_price"),
        (("x", "", ""), "bad_price"),
        (("0", "", ""), "zero_price"),
        (("-1", "", ""), "negative_price"),
        (("1", "", ""), "missing_date"),
        (("1", "x", ""), "bad_date"),
        (("1", DAY, ""), "missing_group"),
    ]
    for (price, day, group), reason in cases:
        assert verdict(one(spark, price, day, group)).reject_reason == reason


def test_every_record_is_on_exactly_one_side(spark, sf_dir):
    from catalog.listings_view import listings

    raw = listings(spark, sf_dir)
    verdicts = classify(raw)
    clean, errors = split(raw)
    ids = lambda df: {r.id for r in df.select("id").collect()}
    assert ids(clean) | ids(errors) == ids(raw)
    assert not ids(clean) & ids(errors)
    assert clean.count() + errors.count() == raw.count()
    assert ids(clean) == ids(verdicts.filter(F.col("reject_reason").isNull()))
    assert rows(errors) == rows(verdicts.filter(F.col("reject_reason").isNotNull()))
    kept = verdicts.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    assert rows(clean) == rows(kept)
    assert python_free(clean) and python_free(errors)


TYPED = Roles(("id",), "g", "p", "d")


@pytest.mark.parametrize("kind", ["double", "float", "decimal(12,4)", "bigint", "string"])
def test_typed_prices_agree_with_their_verdict(spark, kind):
    """The range test on typed columns says what the parsed number says."""
    texts = "0 0.004 0.00499999999 0.005 0.01 1 -1 5.005 99999999 99999999.99 99999999.994 "
    texts += "99999999.995 100000000 123456789"
    data = [(str(i), "g", t) for i, t in enumerate(texts.split())] + [("n", "g", None)]
    df = spark.createDataFrame(data, "id string, g string, p string").select(
        "id", "g", F.col("p").try_cast(kind).alias("p"), F.lit(DAY).cast("timestamp").alias("d")
    )
    verdicts = classify(df, TYPED)
    kept = verdicts.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    assert rows(accepted(df, TYPED)) == rows(kept)
    assert accepted(df, TYPED).count() + rejected(df, TYPED).count() == df.count()
    assert set(r.reject_reason for r in verdicts.collect()) >= {None, "zero_price"}


def test_typed_nan_and_infinity_are_bad(spark):
    data = [("1", "g", float("nan")), ("2", "g", float("inf")), ("3", "g", float("-inf"))]
    df = spark.createDataFrame(data, "id string, g string, p double").withColumn(
        "d", F.lit(DAY).cast("date")
    )
    assert accepted(df, TYPED).count() == 0
    assert {r.reject_reason for r in rejected(df, TYPED).collect()} == {"bad_price"}


def test_typed_filters_reach_the_scan(spark, sf_dir):
    from catalog.queries import ORDER_LINES

    lines = ORDER_LINES.project(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    text = accepted(lines, ORDER_LINES)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(l_extendedprice,0.005)" in text
    assert "l_quantity" not in text.split("== Physical Plan ==")[1]


def test_month_is_formatted_once_per_accepted_row(spark, sf_dir):
    from catalog.queries import ORDER_LINES
    from rategauge.operators import average_prices

    lines = ORDER_LINES.project(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    averages = average_prices(accepted(lines, ORDER_LINES), ORDER_LINES)
    joined = accepted(lines, ORDER_LINES).join(averages, ["year_month", "l_suppkey"])
    assert "isnotnull(date_format" not in joined._jdf.queryExecution().toString().split(
        "== Physical Plan =="
    )[1]


def test_roles(spark):
    with pytest.raises(ValueError):
        Roles((), "g", "p", "d")
    with pytest.raises(ValueError):
        Roles(("g",), "g", "p", "d")
    source = spark.createDataFrame([(1, "a", 2.0, DAY, 9)], "k int, g string, p double, d string, x int")
    renamed = Roles(("k",), "g", "p", "d").rename(source, LISTING)
    assert renamed.columns == LISTING.columns
    with pytest.raises(ValueError):
        Roles(("k", "x"), "g", "p", "d").rename(source, LISTING)


def test_prepare_keeps_other_columns_in_place(spark):
    df = one(spark).withColumn("extra", F.lit(7))
    assert prepare(df).columns == [*df.columns, "price_num", "year_month"]


def test_ansi_setting_does_not_matter(spark):
    data = [(str(i), "g", p, d) for i, (p, d) in enumerate(
        [("N/A", DAY), ("1", "garbage"), ("5", DAY), ("123456789", DAY)])]
    df = spark.createDataFrame(data, SCHEMA)
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        results = []
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            results.append(rows(classify(df)))
        assert results[0] == results[1]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
