"""Call-detail records from CSV, as a table or as a stream, and their Parquet landing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterline.schemas import FULL, Layout
from meterline.sources.paths import expand_home


def _csv_options(layout: Layout, strict_header: bool) -> dict[str, object]:
    options: dict[str, object] = {"header": True, "enforceSchema": not strict_header}
    if layout.trim:
        options |= {
            "ignoreLeadingWhiteSpace": True,
            "ignoreTrailingWhiteSpace": True,
            "nullValue": "",
        }
    return options


def read_cdr(
    spark: SparkSession, path: str, layout: Layout = FULL, strict_header: bool = False
) -> DataFrame:
    """Columns bind by position and the header line is skipped.

    ``strict_header`` makes a file fail whose header differs from the layout.
    """
    options = _csv_options(layout, strict_header)
    return spark.read.schema(layout.schema).options(**options).csv(expand_home(path))


def stream_cdr(
    spark: SparkSession,
    path: str,
    layout: Layout = FULL,
    max_files: int | None = None,
    strict_header: bool = False,
) -> DataFrame:
    """The same files as a stream; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(layout.schema).options(**_csv_options(layout, strict_header))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(expand_home(path))


def read_landed_cdr(spark: SparkSession, path: str) -> DataFrame:
    """Records written by ``land_cdr``; a filter on ``event_date`` prunes whole folders."""
    return spark.read.parquet(expand_home(path))
