"""One aggregate from which all four reports follow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions import event_date, widened_sum_type
from meterline.operators.reports import DELAY, INTERVAL, REVENUE, TIME, name_totals


def roll_up(
    records: DataFrame, key: str = "PAYTYPE_515", width: str = INTERVAL, delay: str = DELAY
) -> DataFrame:
    """Per date, interval and pay type: sum, extremes and count of the records.

    The date is part of the key, so the daily report is exact even where an interval
    crosses midnight of the session zone. Works on tables and on streams.
    """
    return (
        records.withWatermark(TIME, delay)
        .groupBy(F.window(TIME, width), event_date(F.col(TIME)).alias("date"), key)
        .agg(
            F.sum(REVENUE).alias("revenue"),
            F.min(REVENUE).alias("min_revenue"),
            F.max(REVENUE).alias("max_revenue"),
            F.count("*").alias("record_count"),
        )
        .select(
            "date",
            F.col("window.start").alias("interval_start"),
            key,
            "revenue",
            "min_revenue",
            "max_revenue",
            "record_count",
        )
    )


def _sum_again(rolled: DataFrame, name: str):
    # The sum of sums has the type of a plain sum: min_revenue keeps the record's own type.
    sum_type = widened_sum_type(rolled.schema["min_revenue"].dataType)
    return F.sum("revenue").cast(sum_type).alias(name)


def daily_from(rolled: DataFrame) -> DataFrame:
    return rolled.groupBy("date").agg(_sum_again(rolled, "total_revenue")).orderBy("date")


def revenue_from(rolled: DataFrame, key: str = "PAYTYPE_515") -> DataFrame:
    sums = rolled.groupBy(key, "interval_start").agg(_sum_again(rolled, "revenue"))
    return sums.select(key, "revenue", "interval_start").orderBy("interval_start", key)


def min_max_from(rolled: DataFrame, key: str = "PAYTYPE_515") -> DataFrame:
    extremes = rolled.groupBy(key, "interval_start").agg(
        F.min("min_revenue").alias("min_revenue"), F.max("max_revenue").alias("max_revenue")
    )
    return extremes.select(key, "min_revenue", "max_revenue", "interval_start").orderBy(
        "interval_start", key
    )


def count_by_name_from(
    rolled: DataFrame, mapping: DataFrame, key: str = "PAYTYPE_515"
) -> DataFrame:
    sum_type = widened_sum_type(rolled.schema["min_revenue"].dataType)
    named = name_totals(rolled, mapping, key, sum_type)
    return named.orderBy("interval_start", "value")
