"""One query per operator of the survey; each takes ``(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.listings_view import listings, table
from rategauge.operators import (
    accepted,
    add_tracking,
    average_prices,
    average_report,
    classify,
    prepare,
    quality_summary,
    quality_totals,
    ranked_report,
    rejected,
    top_k,
    top_over_under,
)
from rategauge.operators.rank import OVER, UNDER
from rategauge.operators.report import of_month_and_group
from rategauge.plans import (
    MonthlyRun,
    Store,
    csv_reports,
    deviations,
    export_csv,
    join_deviations,
    run_month,
    run_months,
    run_reports,
)
from rategauge.plans.deviations import measure
from rategauge.plans.scratch import scratch_path, stored
from rategauge.plans.store import REJECTED
from rategauge.roles import LISTING, Roles
from rategauge.schemas import (
    AVERAGE_CSV,
    AVERAGE_TABLE,
    MONEY_DDL,
    RANKED_CSV,
    RANKED_TABLE,
    RAW_LISTING,
)
from rategauge.sinks import overwrite_months, write_csv, write_parquet
from rategauge.sources import (
    month_file,
    read_average_table,
    read_listings,
    read_ranked_table,
    require_rows,
)

Query = Callable[[SparkSession, str], DataFrame]

ORDER_LINES = Roles(
    ids=("l_orderkey", "l_linenumber"),
    group="l_suppkey",
    price="l_extendedprice",
    date="l_shipdate",
)
EVENTS = Roles(ids=("event_id",), group="event_type", price="value", date="ts")

#: Arguments the reports are asked with; the SQL uses the same.
MONTH = "1997-05"
GROUP = "nAtIoN_7"
TOP = 10
REPORT_ROWS = 12

KEYS = ("year_month", LISTING.group)
DIFF_COLUMNS = (*KEYS, "id", "price_num", "avg_price", "price_diff", "pct_diff")


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(listings(spark, sf_dir))


def _stored_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view is a join: stored once, it need not be joined again for each pass."""
    return stored(_clean(spark, sf_dir), "clean")


def _diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deviations(_stored_clean(spark, sf_dir))


# -- cleaning ---------------------------------------------------------------


def price_parse(spark, sf_dir):
    return prepare(listings(spark, sf_dir)).select("id", "price", "price_num")


def month_key(spark, sf_dir):
    return prepare(listings(spark, sf_dir)).select("id", "last_scraped", "year_month")


def clean_accept(spark, sf_dir):
    return _clean(spark, sf_dir).select("id", LISTING.group, "price_num", "year_month")


def clean_reject(spark, sf_dir):
    return rejected(listings(spark, sf_dir)).select("id", "reject_reason")


def clean_split(spark, sf_dir):
    verdict = F.coalesce("reject_reason", F.lit("accepted"))
    return classify(listings(spark, sf_dir)).select("id", verdict.alias("verdict"))


def quality_by_reason(spark, sf_dir):
    return quality_summary(classify(listings(spark, sf_dir)))


def quality_by_month(spark, sf_dir):
    return quality_totals(classify(listings(spark, sf_dir)), ["year_month"])


# -- averages, deviations, ranks --------------------------------------------


def avg_price(spark, sf_dir):
    return average_prices(_clean(spark, sf_dir))


def price_diffs(spark, sf_dir):
    return _diffs(spark, sf_dir).select(*DIFF_COLUMNS)


def price_diffs_split(spark, sf_dir):
    """The way taken when the averages are too many to broadcast: a bound of half their size."""
    clean = _stored_clean(spark, sf_dir)
    averages = stored(average_prices(clean), "averages")
    diffs = join_deviations(clean, averages, broadcast_bytes=measure(averages).bytes // 2)
    return diffs.select(*DIFF_COLUMNS)


def top_over(spark, sf_dir):
    return top_k(_diffs(spark, sf_dir), TOP, OVER).select(*DIFF_COLUMNS)


def top_under(spark, sf_dir):
    return top_k(_diffs(spark, sf_dir), TOP, UNDER).select(*DIFF_COLUMNS)


def top_both_sides(spark, sf_dir):
    over, under = top_over_under(_diffs(spark, sf_dir), TOP)
    sides = ((OVER, over), (UNDER, under))
    first, second = (df.select(F.lit(side).alias("side"), *DIFF_COLUMNS) for side, df in sides)
    return first.unionByName(second)


def top_over_monthly(spark, sf_dir):
    diffs = _diffs(spark, sf_dir)
    return top_k(diffs, 3, OVER, partition_by=KEYS).select(*DIFF_COLUMNS)


# -- reports ----------------------------------------------------------------


def report_avg_all(spark, sf_dir):
    return average_report(avg_price(spark, sf_dir))


def report_avg_month(spark, sf_dir):
    return average_report(avg_price(spark, sf_dir), month=MONTH)


def report_avg_group(spark, sf_dir):
    return average_report(avg_price(spark, sf_dir), group=GROUP)


def _ranked(spark: SparkSession, sf_dir: str, side: str, **filters) -> DataFrame:
    """The view is a join: what the filters leave of it is stored once, for averages and ranks."""
    clean = of_month_and_group(_clean(spark, sf_dir), filters.get("month"), filters.get("group"))
    diffs = deviations(stored(clean, "clean"))
    return ranked_report(diffs, REPORT_ROWS, side, **filters).select(*DIFF_COLUMNS, "rank")


def report_over_all(spark, sf_dir):
    return _ranked(spark, sf_dir, OVER)


def report_under_all(spark, sf_dir):
    return _ranked(spark, sf_dir, UNDER)


def report_over_month(spark, sf_dir):
    return _ranked(spark, sf_dir, OVER, month=MONTH)


def report_over_one(spark, sf_dir):
    return _ranked(spark, sf_dir, OVER, group=GROUP)


def report_under_one(spark, sf_dir):
    return _ranked(spark, sf_dir, UNDER, group=GROUP)


# -- tracking, sources, sinks -----------------------------------------------


def tracking(spark, sf_dir):
    tracked = add_tracking(_clean(spark, sf_dir), "in/listings_1997-05.csv", "batch_1", "adhoc")
    return tracked.select("id", "source_file", "run_type", "final_log_file_name")


def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "listings_csv")
    write_csv(_clean(spark, sf_dir).select(*RAW_LISTING.names), path)
    return read_listings(spark, path).select("id", LISTING.group, "price")


def csv_text_roundtrip(spark, sf_dir):
    """Whole texts with line breaks, commas and quotes through CSV; the data decide how it is read."""
    path = scratch_path(spark, "documents_csv")
    write_csv(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    read = read_listings(spark, path)
    return read.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def csv_schema_read(spark, sf_dir):
    path = scratch_path(spark, "listings_csv")
    write_csv(_clean(spark, sf_dir).select(*RAW_LISTING.names), path)
    read = read_listings(spark, path, schema=RAW_LISTING)
    return require_rows(read).select("id", LISTING.group, "price")


def csv_infer_read(spark, sf_dir):
    path = scratch_path(spark, "part_csv")
    write_csv(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice"), path)
    return read_listings(spark, path, infer_schema=True).select("p_partkey", "p_retailprice")


def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "accepted")
    clean = _clean(spark, sf_dir).select("id", LISTING.group, "price_num", "year_month")
    write_parquet(clean.hint("rebalance", F.col("year_month")), path, ["year_month"])
    schema = "id string, neighbourhood_cleansed string, price_num decimal(10,2), year_month string"
    return spark.read.schema(schema).parquet(path)


def month_backfill(spark, sf_dir):
    """Store all months, rerun one twice, count what is there."""
    path = scratch_path(spark, "accepted_by_month")
    clean = _stored_clean(spark, sf_dir).select("id", LISTING.group, "price_num", "year_month")
    write_parquet(clean.hint("rebalance", F.col("year_month")), path, ["year_month"])
    for _ in range(2):
        overwrite_months(clean, path, [MONTH])
    schema = "id string, neighbourhood_cleansed string, price_num decimal(10,2), year_month string"
    stored = spark.read.schema(schema).parquet(path)
    return stored.groupBy("year_month").agg(F.count("*").alias("row_count"))


def stored_avg_csv(spark, sf_dir):
    """Averages through the CSV exchange format, then the report."""
    path = scratch_path(spark, "avg_csv")
    tracked = add_tracking(avg_price(spark, sf_dir), "listings.csv", "batch_1")
    write_csv(tracked.select(*AVERAGE_CSV.names), path)
    return average_report(read_average_table(spark, path, fmt="csv"), group=GROUP)


def stored_over_csv(spark, sf_dir):
    """Over-priced lists through the CSV exchange format, then the report."""
    path = scratch_path(spark, "over_csv")
    tops = add_tracking(top_k(_diffs(spark, sf_dir), TOP, OVER), "listings.csv", "batch_1")
    write_csv(tops.select(*RANKED_CSV.names), path)
    report = ranked_report(read_ranked_table(spark, path, OVER, fmt="csv"), 5, OVER)
    return report.select(*DIFF_COLUMNS, "rank")


# -- the monthly run, from raw CSV to published tables -------------------------


def _monthly(spark: SparkSession, sf_dir: str, times: int = 1) -> Store:
    """The whole view written as one month's input, then run."""
    root = scratch_path(spark, "run")
    source = month_file(f"{root}/in", MONTH)
    write_csv(listings(spark, sf_dir), source)
    run = MonthlyRun(MONTH, source, f"{root}/out", "batch_1", "adhoc", top_k=TOP)
    for _ in range(times - 1):
        run_month(spark, run)
    return run_month(spark, run)


def monthly_averages(spark, sf_dir):
    averages = _monthly(spark, sf_dir).averages()
    return averages.select(*KEYS, "listing_count", "avg_price", "run_type", "final_log_file_name")


def monthly_rejects(spark, sf_dir):
    return _monthly(spark, sf_dir).classified(REJECTED).select("id", "reject_reason", "run_type")


def monthly_audit(spark, sf_dir):
    """Two runs of one month: counts agree, and the audit keeps both."""
    audit = _monthly(spark, sf_dir, times=2).audit()
    return audit.groupBy("month", "status").agg(
        F.sum("rows_read").alias("rows_read"),
        F.sum("rows_accepted").alias("rows_accepted"),
        F.sum("rows_rejected").alias("rows_rejected"),
        F.sum("bad_price").alias("bad_price"),
    )


def monthly_report_avg(spark, sf_dir):
    return run_reports(spark, _monthly(spark, sf_dir).root, month=MONTH).average


def monthly_report_over(spark, sf_dir):
    report = run_reports(spark, _monthly(spark, sf_dir).root, n=5).over
    return report.select(*DIFF_COLUMNS, "rank")


def monthly_report_over_deep(spark, sf_dir):
    """Three times as many records as the lists hold, of one month."""
    report = run_reports(spark, _monthly(spark, sf_dir).root, month=MONTH, n=3 * TOP).over
    return report.select(*DIFF_COLUMNS, "rank")


def monthly_report_under(spark, sf_dir):
    report = run_reports(spark, _monthly(spark, sf_dir).root, group=GROUP, n=5).under
    return report.select(*DIFF_COLUMNS, "rank")


def monthly_report_csv(spark, sf_dir):
    """The second job reads what the first one exported as CSV."""
    root = _monthly(spark, sf_dir).root
    report = csv_reports(spark, export_csv(spark, root, f"{root}/csv"), group=GROUP, n=5).under
    return report.select(*DIFF_COLUMNS, "rank")


def monthly_lineitem_averages(spark, sf_dir):
    """The run on a table with columns of its own, two of which identify a record."""
    root = scratch_path(spark, "lines")
    source = month_file(f"{root}/in", MONTH, "lineitem")
    lines = ORDER_LINES.project(table(spark, sf_dir, "lineitem"))
    write_csv(lines.withColumn("l_shipdate", F.col("l_shipdate").cast("date")), source)
    run = MonthlyRun(MONTH, source, f"{root}/out", "lines_1", "adhoc", top_k=TOP, roles=ORDER_LINES)
    averages = run_month(spark, run).averages()
    return averages.select("year_month", ORDER_LINES.group, "listing_count", "avg_price")


def _halves(spark: SparkSession, sf_dir: str, root: str) -> list[str]:
    """Two input files that both hold records of all months."""
    view = stored(listings(spark, sf_dir), "view")
    halves = {"1997-05": 0, "1997-06": 1}
    for month, rest in halves.items():
        of_run = view.filter(F.pmod(F.xxhash64("id"), F.lit(2)) == rest)
        write_csv(of_run, month_file(f"{root}/in", month))
    return list(halves)


def _backfill(spark: SparkSession, sf_dir: str) -> str:
    """A run for each of two files, the first one rerun."""
    root = scratch_path(spark, "backfill")
    first, second = _halves(spark, sf_dir, root)
    for month in (first, second, first):
        source = month_file(f"{root}/in", month)
        run_month(spark, MonthlyRun(month, source, f"{root}/out", "fill", "adhoc", top_k=TOP))
    return f"{root}/out"


def backfill_report_avg(spark, sf_dir):
    return run_reports(spark, _backfill(spark, sf_dir)).average


def backfill_report_over(spark, sf_dir):
    report = run_reports(spark, _backfill(spark, sf_dir), n=5).over
    return report.select(*DIFF_COLUMNS, "rank")


def backfill_one_pass(spark, sf_dir):
    """Both files in one run; the audit has rows of each, the averages are of both."""
    root = scratch_path(spark, "one_pass")
    store = run_months(spark, _halves(spark, sf_dir, root), f"{root}/in", f"{root}/out", "fill", top_k=TOP)
    read = store.audit().groupBy("year_month").agg(F.sum("rows_accepted").alias("rows_accepted"))
    return store.averages().join(read, "year_month").select(*KEYS, "listing_count", "avg_price", "rows_accepted")


# -- other tables through other roles ----------------------------------------


def roles_lineitem_avg(spark, sf_dir):
    lines = ORDER_LINES.project(table(spark, sf_dir, "lineitem"))
    return average_prices(accepted(lines, ORDER_LINES), ORDER_LINES)


def roles_lineitem_top(spark, sf_dir):
    lines = ORDER_LINES.project(table(spark, sf_dir, "lineitem"))
    diffs = deviations(accepted(lines, ORDER_LINES), ORDER_LINES)
    return top_k(diffs, 3, OVER, ORDER_LINES, keep_rank=True).select(
        "year_month", *ORDER_LINES.ids, ORDER_LINES.group, "price_num", "pct_diff", "rank"
    )


def roles_events_avg(spark, sf_dir):
    events = EVENTS.project(table(spark, sf_dir, "events"))
    return average_prices(accepted(events, EVENTS), EVENTS)


def roles_events_top(spark, sf_dir):
    events = EVENTS.project(table(spark, sf_dir, "events"))
    diffs = deviations(accepted(events, EVENTS), EVENTS)
    return top_k(diffs, 5, OVER, EVENTS).select(
        "year_month", EVENTS.group, "event_id", "price_num", "avg_price", "price_diff", "pct_diff"
    )


def roles_events_renamed(spark, sf_dir):
    """Columns renamed to the listing names, then the default operators."""
    events = EVENTS.rename(table(spark, sf_dir, "events"), LISTING)
    return quality_totals(classify(events), ["year_month"])


QUERIES: dict[str, Query] = {
    "price_parse": price_parse,
    "month_key": month_key,
    "clean_accept": clean_accept,
    "clean_reject": clean_reject,
    "clean_split": clean_split,
    "quality_summary": quality_by_reason,
    "quality_by_month": quality_by_month,
    "avg_price": avg_price,
    "price_diffs": price_diffs,
    "price_diffs_split": price_diffs_split,
    "top_over": top_over,
    "top_under": top_under,
    "top_over_under": top_both_sides,
    "top_over_monthly": top_over_monthly,
    "report_avg_all": report_avg_all,
    "report_avg_month": report_avg_month,
    "report_avg_group": report_avg_group,
    "report_over_all": report_over_all,
    "report_under_all": report_under_all,
    "report_over_month": report_over_month,
    "report_over_one": report_over_one,
    "report_under_one": report_under_one,
    "tracking": tracking,
    "csv_roundtrip": csv_roundtrip,
    "csv_text_roundtrip": csv_text_roundtrip,
    "csv_schema_read": csv_schema_read,
    "csv_infer_read": csv_infer_read,
    "parquet_roundtrip": parquet_roundtrip,
    "month_backfill": month_backfill,
    "stored_avg_csv": stored_avg_csv,
    "stored_over_csv": stored_over_csv,
    "monthly_averages": monthly_averages,
    "monthly_rejects": monthly_rejects,
    "monthly_audit": monthly_audit,
    "monthly_report_avg": monthly_report_avg,
    "monthly_report_over": monthly_report_over,
    "monthly_report_over_deep": monthly_report_over_deep,
    "monthly_report_under": monthly_report_under,
    "monthly_report_csv": monthly_report_csv,
    "monthly_lineitem_averages": monthly_lineitem_averages,
    "backfill_report_avg": backfill_report_avg,
    "backfill_report_over": backfill_report_over,
    "backfill_one_pass": backfill_one_pass,
    "roles_lineitem_avg": roles_lineitem_avg,
    "roles_lineitem_top": roles_lineitem_top,
    "roles_events_avg": roles_events_avg,
    "roles_events_top": roles_events_top,
    "roles_events_renamed": roles_events_renamed,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
