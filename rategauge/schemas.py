"""Fixed schemas of the raw input and of the stored tables.  All nullable."""

from __future__ import annotations

from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from rategauge.roles import LISTING, Roles

MONEY = DecimalType(10, 2)
MONEY_DDL = "decimal(10,2)"


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


def raw_table(roles: Roles = LISTING) -> StructType:
    """Raw records.  Text throughout: parsing is the cleaning step's job."""
    return _schema(*((name, StringType()) for name in roles.columns))


RAW_LISTING = raw_table()

TRACKING_COLUMNS = (
    "processing_timestamp",
    "source_file",
    "run_type",
    "final_log_file_name",
)


def _tracking(timestamp_type) -> list[tuple[str, object]]:
    first, *rest = TRACKING_COLUMNS
    return [(first, timestamp_type), *((name, StringType()) for name in rest)]


def average_table(roles: Roles = LISTING, timestamp=TimestampType(), count=LongType()) -> StructType:
    """Averages as stored: processing time typed, room for counts beyond 2^31."""
    return _schema(
        ("year_month", StringType()),
        (roles.group, StringType()),
        ("listing_count", count),
        ("avg_price", MONEY),
        *_tracking(timestamp),
    )


def ranked_table(roles: Roles = LISTING, timestamp=TimestampType(), count=LongType()) -> StructType:
    """Top lists as stored."""
    return _schema(
        ("year_month", StringType()),
        (roles.group, StringType()),
        *((name, StringType()) for name in (*roles.ids, roles.price, roles.date)),
        ("price_num", MONEY),
        ("listing_count", count),
        ("avg_price", MONEY),
        ("price_diff", MONEY),
        ("pct_diff", MONEY),
        *_tracking(timestamp),
    )


def classified_table(roles: Roles = LISTING) -> StructType:
    """Classified records as stored by a run, without the columns that part folders."""
    return _schema(
        *((name, StringType()) for name in roles.columns),
        ("price_num", MONEY),
        ("year_month", StringType()),
        ("reject_reason", StringType()),
        *_tracking(TimestampType()),
    )


def states_table(roles: Roles = LISTING) -> StructType:
    """What a run adds to an average: mergeable by addition."""
    return _schema(
        ("run_month", StringType()),
        ("year_month", StringType()),
        (roles.group, StringType()),
        ("listing_count", LongType()),
        ("cents", LongType()),
    )


def extremes_table(roles: Roles = LISTING) -> StructType:
    """A run's dearest and cheapest records per month and group, and the first one left out."""
    return _schema(
        ("run_month", StringType()),
        ("side", StringType()),
        ("place", IntegerType()),
        ("kept", IntegerType()),
        *((name, StringType()) for name in roles.columns),
        ("price_num", MONEY),
        ("year_month", StringType()),
        ("source_file", StringType()),
    )


#: Exchange format (CSV): processing time as text, counts as int.
AVERAGE_CSV = average_table(LISTING, StringType(), IntegerType())
RANKED_CSV = ranked_table(LISTING, StringType(), IntegerType())

#: Parquet tables of listings.
AVERAGE_TABLE = average_table()
RANKED_TABLE = ranked_table()

#: Reject reasons; a record failing several tests gets the first in this order.
REJECT_REASONS = (
    "missing_price",
    "bad_price",
    "zero_price",
    "negative_price",
    "missing_date",
    "bad_date",
    "missing_group",
)

#: One audit row per run, source file and data month.
AUDIT_TABLE = _schema(
    ("final_log_file_name", StringType()),
    ("timestamp", TimestampType()),
    ("month", StringType()),
    ("run_type", StringType()),
    ("file_path", StringType()),
    ("status", StringType()),
    ("message", StringType()),
    ("source_file", StringType()),
    ("year_month", StringType()),
    ("rows_read", LongType()),
    ("rows_accepted", LongType()),
    ("rows_rejected", LongType()),
    *((reason, LongType()) for reason in REJECT_REASONS),
)
