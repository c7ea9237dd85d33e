"""Runs that read, compute and store."""

from rategauge.plans.deviations import deviations, join_deviations
from rategauge.plans.manifest import BaseMoved, Manifest
from rategauge.plans.monthly import MonthlyRun, run_month, run_months
from rategauge.plans.reports import Reports, csv_reports, export_csv, run_reports
from rategauge.plans.store import Store

__all__ = [
    "BaseMoved",
    "Manifest",
    "MonthlyRun",
    "Reports",
    "Store",
    "csv_reports",
    "deviations",
    "export_csv",
    "join_deviations",
    "run_month",
    "run_months",
    "run_reports",
]
