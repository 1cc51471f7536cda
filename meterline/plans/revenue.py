"""All four revenue reports from one pass over the records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from meterline.operators import rollup
from meterline.operators.reports import INTERVAL
from meterline.session import cut_lineage
from meterline.sinks.reports import preview, write_report

# The folder of each report below a target.
FOLDERS = {
    "daily_revenue": "daily_revenue",
    "interval_revenue": "revenue_15min_by_paytype",
    "interval_min_max": "revenue_15min_minmax_by_paytype",
    "interval_count_by_name": "revenue_count_15min_by_paytype",
}


@dataclass(frozen=True)
class ReportSet:
    daily_revenue: DataFrame
    interval_revenue: DataFrame
    interval_min_max: DataFrame
    interval_count_by_name: DataFrame


def reports_from(rolled: DataFrame, mapping: DataFrame, key: str = "PAYTYPE_515") -> ReportSet:
    return ReportSet(
        daily_revenue=rollup.daily_from(rolled),
        interval_revenue=rollup.revenue_from(rolled, key),
        interval_min_max=rollup.min_max_from(rolled, key),
        interval_count_by_name=rollup.count_by_name_from(rolled, mapping, key),
    )


def report_set(
    records: DataFrame, mapping: DataFrame, key: str = "PAYTYPE_515", width: str = INTERVAL
) -> ReportSet:
    """The four reports over one roll-up, which is written to the shared folder.

    The records are scanned once. What the reports read has a row per interval and pay
    type, however many records there are.
    """
    return reports_from(cut_lineage(rollup.roll_up(records, key, width)), mapping, key)


def run_reports(
    records: DataFrame,
    mapping: DataFrame,
    targets: list[str],
    key: str = "PAYTYPE_515",
    width: str = INTERVAL,
    single_file: bool = False,
    show: bool = False,
) -> ReportSet:
    """Compute the four reports and write each below every target folder or URI."""
    reports = report_set(records, mapping, key, width)
    if show:
        records.printSchema()
    for name, folder in FOLDERS.items():
        report = getattr(reports, name)
        if show:
            preview(report, show=True)
        write_report(report, [f"{target}/{folder}" for target in targets], single_file)
    return reports
