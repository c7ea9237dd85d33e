"""DataFrame in, DataFrame out.  All lazy; the caller's action runs the plan."""

from rategauge.operators.clean import accepted, classify, prepare, rejected, split
from rategauge.operators.metrics import average_prices, price_diffs
from rategauge.operators.quality import quality_summary, quality_totals
from rategauge.operators.rank import top_k, top_over_under
from rategauge.operators.report import (
    ALL_GROUPS,
    average_report,
    over_under_report,
    ranked_report,
    show_report,
)
from rategauge.operators.tracking import add_tracking

__all__ = [
    "ALL_GROUPS",
    "accepted",
    "add_tracking",
    "average_prices",
    "average_report",
    "classify",
    "over_under_report",
    "prepare",
    "price_diffs",
    "quality_summary",
    "quality_totals",
    "ranked_report",
    "rejected",
    "show_report",
    "split",
    "top_k",
    "top_over_under",
]
