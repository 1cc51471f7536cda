from __future__ import annotations

from pyspark.sql import DataFrame

from meterline.sources.paths import expand_home


def write_report(
    report: DataFrame, targets: list[str], single_file: bool = False, form: str = "csv"
) -> None:
    """Write a report to every target: folders, or URIs of any file system Spark knows.

    With several targets the report is computed once. ``single_file`` gives one sorted
    file, which is meant for reports of days or intervals, not for large tables.
    """
    several = len(targets) > 1
    source = report.persist() if several else report
    try:
        out = source.coalesce(1) if single_file else source
        for target in targets:
            writer = out.write.mode("overwrite").format(form)
            if form == "csv":
                writer = writer.option("header", True)
            writer.save(expand_home(target))
    finally:
        if several:
            source.unpersist()


def preview(report: DataFrame, n: int = 10, show: bool = False) -> DataFrame:
    """The first rows of a report, printed if asked; after a sort this is a top-n plan."""
    first = report.limit(n)
    if show:
        first.show(n, truncate=False)
    return first
