"""Readers.  Each returns a lazy DataFrame."""

from rategauge.sources.guards import require_rows
from rategauge.sources.listings import month_file, read_listings
from rategauge.sources.tables import (
    read_average_table,
    read_over_under_tables,
    read_ranked_table,
    read_table,
)

__all__ = [
    "month_file",
    "read_average_table",
    "read_listings",
    "read_over_under_tables",
    "read_ranked_table",
    "read_table",
    "require_rows",
]
