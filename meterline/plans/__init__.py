"""Whole jobs made of the operators: reports, dimension loads and answered requests."""

from meterline.plans.dimension import load_dimension, load_into, put_rows, read_loads
from meterline.plans.landed import read_roll_up, refresh_roll_up
from meterline.plans.requests import answer_requests, rate_load
from meterline.plans.revenue import ReportSet, report_set, reports_from, run_reports

__all__ = [
    "ReportSet",
    "answer_requests",
    "load_dimension",
    "load_into",
    "put_rows",
    "rate_load",
    "read_loads",
    "read_roll_up",
    "refresh_roll_up",
    "report_set",
    "reports_from",
    "run_reports",
]
