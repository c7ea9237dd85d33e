"""Top lists and reports: small examples, ties, NULLs, order, plans."""

from __future__ import annotations

from decimal import Decimal as D

import pytest

from rategauge.operators import (
    average_report,
    over_under_report,
    ranked_report,
    show_report,
    top_k,
    top_over_under,
)
from tests.helpers import ordered, plan, rows

DIFFS = (
    "id string, neighbourhood_cleansed string, year_month string, price_num decimal(10,2), "
    "pct_diff decimal(10,2)"
)


def diffs(spark, records):
    return spark.createDataFrame(
        [(i, g, m, D(1), None if p is None else D(p)) for i, g, m, p in records], DIFFS
    )


def test_top_lists_take_both_ends(spark):
    df = diffs(spark, [(f"{g}{i:02d}", g, "2031-07", (i * 37) % 101 - 50) for g in "pq" for i in range(17)])
    over, under = top_over_under(df, 4)
    values = sorted((i * 37) % 101 - 50 for i in range(17))
    assert over.count() == under.count() == 8
    assert sorted({int(r.pct_diff) for r in over.collect()}) == values[-4:]
    assert sorted({int(r.pct_diff) for r in under.collect()}) == values[:4]
    assert over.columns == df.columns


def test_ties_go_to_the_smaller_id(spark):
    df = diffs(spark, [(str(i), "a", "2025-01", 5) for i in (9, 3, 7, 1)])
    assert rows(top_k(df, 2), "id") == [("1",), ("3",)]
    assert rows(top_k(df, 2, "under"), "id") == [("1",), ("3",)]


def test_null_deviation_ranks_last_on_both_sides(spark):
    df = diffs(spark, [("1", "a", "m", None), ("2", "a", "m", 4), ("3", "a", "m", -4)])
    over, under = top_over_under(df, 2)
    assert rows(over, "id") == [("2",), ("3",)] and rows(under, "id") == [("2",), ("3",)]
    assert rows(top_k(df, 3), "id") == [("1",), ("2",), ("3",)]


def test_months_share_one_list_unless_asked(spark):
    df = diffs(spark, [(f"{m}{i}", "a", f"2025-0{m}", i) for m in (1, 2) for i in range(4)])
    assert top_k(df, 3).count() == 3
    monthly = top_k(df, 3, partition_by=("year_month", "neighbourhood_cleansed"))
    assert monthly.count() == 6


def test_list_size_is_the_smaller_of_k_and_group(spark):
    df = diffs(spark, [(f"{g}{i}", g, "m", i) for g, n in (("a", 3), ("b", 12)) for i in range(n)])
    counts = {g: n for g, n in rows(top_k(df, 5).groupBy("neighbourhood_cleansed").count())}
    assert counts == {"a": 3, "b": 5}


def test_bad_side(spark):
    with pytest.raises(ValueError):
        top_k(diffs(spark, []).limit(0), 1, "sideways")


def test_rows_are_cut_before_the_shuffle(spark, sf_dir):
    from catalog.queries import _diffs

    for side in ("over", "under"):
        text = plan(top_k(_diffs(spark, sf_dir), 10, side))
        last_exchange = text.index("Exchange hashpartitioning(neighbourhood_cleansed")
        assert "WindowGroupLimit" in text[last_exchange:], text
        assert "Partial" in text[last_exchange:]


AVG = (
    "year_month string, neighbourhood_cleansed string, listing_count bigint, avg_price double"
)
AVG_ROWS = [("2031-07", "Quay", 3, 9.5), ("2031-08", "Quay", 4, 12.25), ("2031-07", "Mill", 1, 12.25)]


def test_average_report(spark):
    df = spark.createDataFrame(AVG_ROWS, AVG)
    assert ordered(average_report(df, "2031-07", "qUAY")) == [("2031-07", "Quay", 9.5)]
    everything = [("2031-07", "Mill", 12.25), ("2031-08", "Quay", 12.25), ("2031-07", "Quay", 9.5)]
    assert ordered(average_report(df, None, "ALL")) == everything
    assert ordered(average_report(df, "", None)) == everything
    assert ordered(average_report(df, "1970-01")) == []


def test_ranked_report_all_groups(spark):
    df = diffs(spark, [
        ("1", "b", "m", 5), ("2", "b", "m", 9), ("3", "a", "m", -1), ("4", "a", "m", 2), ("5", "b", "m", 1),
    ])
    columns = ("neighbourhood_cleansed", "id", "rank")
    assert ordered(ranked_report(df, 2), *columns) == [("a", "4", 1), ("a", "3", 2), ("b", "2", 1), ("b", "1", 2)]
    assert ordered(ranked_report(df, 2, "under"), *columns) == [
        ("a", "3", 1), ("a", "4", 2), ("b", "5", 1), ("b", "1", 2)]
    assert ordered(ranked_report(df, 2, group=None), *columns) == ordered(ranked_report(df, "2"), *columns)


def test_ranked_report_one_group_spans_spellings(spark):
    df = diffs(spark, [("1", "Soho", "m", 5), ("2", "SOHO", "m", 9), ("3", "x", "m", 99), ("4", "soho", "n", 7)])
    report = ranked_report(df, 2, group="soHo")
    assert ordered(report, "id", "rank") == [("2", 1), ("4", 2)]
    assert ordered(ranked_report(df, 5, "under", "m", "soho"), "id", "rank") == [("1", 1), ("2", 2)]
    assert "TakeOrderedAndProject" in plan(report)


def test_each_side_comes_from_its_own_table(spark):
    high = diffs(spark, [("h1", "Quay", "m", 8), ("h2", "Quay", "m", 3), ("h3", "Mill", "m", 9)])
    low = diffs(spark, [("l1", "Quay", "m", -8), ("l2", "quay", "m", -3), ("l3", "Quay", "n", -99)])
    over, under = over_under_report(high, low, 2, "m", "quay")
    assert ordered(over, "id", "rank") == [("h1", 1), ("h2", 2)]
    assert ordered(under, "id", "rank") == [("l1", 1), ("l2", 2)]


def test_show_prints_at_most_the_given_rows(spark, capsys):
    show_report(diffs(spark, [(str(i), "x" * 40, "m", i) for i in range(30)]), 3)
    printed = capsys.readouterr().out
    assert printed.count("x" * 40) == 3 and "only showing top 3 rows" in printed
