from __future__ import annotations

from pyspark.sql import DataFrame


def rows(df: DataFrame) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


def bag(df: DataFrame) -> list[tuple]:
    return sorted(rows(df), key=repr)


def plan(df: DataFrame) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)
