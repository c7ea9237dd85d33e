"""Column expressions.  All built-in Spark functions; nothing leaves the JVM."""

from rategauge.functions.money import (
    amount_deviation,
    exact_mean,
    exact_sum,
    exact_total,
    has_positive_price,
    mean_of,
    parse_price,
    percent_deviation,
)
from rategauge.functions.text import blank_to_null, is_blank, same_text
from rategauge.functions.time import as_date, month_key

__all__ = [
    "amount_deviation",
    "as_date",
    "blank_to_null",
    "exact_mean",
    "exact_sum",
    "exact_total",
    "has_positive_price",
    "is_blank",
    "mean_of",
    "month_key",
    "parse_price",
    "percent_deviation",
    "same_text",
]
