"""The keyed dimension as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from meterline.schemas import DIMENSION
from meterline.sinks.versions import read_latest


def empty_dimension(spark: SparkSession, schema: T.StructType = DIMENSION) -> DataFrame:
    """What a dimension is before its first load."""
    return spark.createDataFrame([], schema)


def read_dimension(
    spark: SparkSession,
    path: str | None = None,
    table: str | None = None,
    schema: T.StructType = DIMENSION,
) -> DataFrame:
    """The newest complete version below ``path``, or a table of the session's catalog."""
    if table:
        spark.catalog.refreshTable(table)
        return spark.read.table(table)
    newest = read_latest(spark, path)
    return empty_dimension(spark, schema) if newest is None else newest
