"""The small table that names payment-type codes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.schemas import FALLBACK_MAPPING, MAPPING
from meterline.sources.paths import expand_home


def builtin_mapping(
    spark: SparkSession, rows: Iterable[tuple[int, str]] = tuple(FALLBACK_MAPPING)
) -> DataFrame:
    return spark.createDataFrame(list(rows), MAPPING)


def _read_mapping(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith((".xlsx", ".xls")):
        raise ValueError(f"{path} is a sheet: save it as CSV or Parquet, which Spark reads")
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    return spark.read.schema(MAPPING).option("header", True).csv(path)


def load_mapping(
    spark: SparkSession,
    path: str,
    fallback: Iterable[tuple[int, str]] | None = None,
    validate_unique: bool = False,
) -> DataFrame:
    """Read the mapping from CSV or Parquet.

    ``fallback`` rows replace a mapping whose path does not exist; without them the error is
    raised. Every other error is raised too, also that of a sheet.
    A code that occurs more than once multiplies its records, unless ``validate_unique``
    turns it into an error.
    """
    try:
        mapping = _read_mapping(spark, expand_home(path))
    except AnalysisException as error:
        if fallback is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return builtin_mapping(spark, fallback)
    if validate_unique:
        repeated = mapping.groupBy("PayType").count().filter(F.col("count") > 1).take(5)
        if repeated:
            codes = ", ".join(str(row["PayType"]) for row in repeated)
            raise ValueError(f"payment types with more than one name: {codes}")
    return mapping
