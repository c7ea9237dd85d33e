"""Writers."""

from rategauge.sinks.files import write_csv, write_parquet
from rategauge.sinks.months import overwrite_months, overwrite_partition

__all__ = ["overwrite_months", "overwrite_partition", "write_csv", "write_parquet"]
