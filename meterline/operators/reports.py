"""The four revenue reports, each straight from prepared records.

All of them take a table or a stream. A table gives a sorted report. A stream gives an
unsorted one, because only complete mode may sort, and its daily report is keyed by a
one-day window, because a plain date carries no watermark.

Every aggregate here combines on the map side, so a pay type or an interval that holds a
large share of all records adds one row per task to the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions import event_date, widened_sum_type
from meterline.operators.joins import sized_join

# The columns that preparation adds, the interval and the watermark delay.
TIME = "timestamp"
REVENUE = "revenue_toman"
INTERVAL = "15 minutes"
DELAY = "1 day"


def _report(grouped: DataFrame, *order: str) -> DataFrame:
    return grouped if grouped.isStreaming else grouped.orderBy(*order)


def _by_interval(
    records: DataFrame, width: str, delay: str, keys: list[str], aggregates: list[Column]
) -> DataFrame:
    return (
        records.withWatermark(TIME, delay)
        .groupBy(F.window(TIME, width), *keys)
        .agg(*aggregates)
        .withColumn("interval_start", F.col("window.start"))
        .drop("window")
    )


def daily_revenue(
    records: DataFrame, delay: str = DELAY, day_starts: str | None = None
) -> DataFrame:
    """``date, total_revenue``.

    A stream's days are windows of 24 hours from UTC midnight. In another zone of a fixed
    offset pass that of its midnight as ``day_starts``, for example ``"20 hours 30 minutes"``.
    For a zone with summer time keep the dates of ``roll_up``, as ``start_reports`` does.
    """
    total = F.sum(REVENUE).alias("total_revenue")
    if not records.isStreaming:
        return records.groupBy(event_date(F.col(TIME)).alias("date")).agg(total).orderBy("date")
    zone = records.sparkSession.conf.get("spark.sql.session.timeZone")
    if day_starts is None and zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"days of {zone} need day_starts, or the dates of roll_up")
    day = F.window(TIME, "1 day", startTime=day_starts)
    totals = records.withWatermark(TIME, delay).groupBy(day).agg(total)
    return totals.select(event_date(F.col("window.start")).alias("date"), "total_revenue")


def interval_revenue(
    records: DataFrame, key: str = "PAYTYPE_515", width: str = INTERVAL, delay: str = DELAY
) -> DataFrame:
    """``<key>, revenue, interval_start``: revenue per interval and pay type."""
    sums = _by_interval(records, width, delay, [key], [F.sum(REVENUE).alias("revenue")])
    return _report(sums, "interval_start", key)


def interval_min_max(
    records: DataFrame, key: str = "PAYTYPE_515", width: str = INTERVAL, delay: str = DELAY
) -> DataFrame:
    """Smallest and largest single record per interval and pay type."""
    extremes = [F.min(REVENUE).alias("min_revenue"), F.max(REVENUE).alias("max_revenue")]
    return _report(_by_interval(records, width, delay, [key], extremes), "interval_start", key)


def name_totals(totals: DataFrame, mapping: DataFrame, key: str, sum_type) -> DataFrame:
    """Name the codes of per-code interval totals and add up the codes of one name.

    ``totals`` has ``interval_start, <key>, record_count, revenue``. Equal to naming every
    record first, also for repeated codes: each copy of a code counts its records again.
    """
    names = mapping.groupBy(F.col("PayType").alias(key), "value").agg(F.count("*").alias("copies"))
    # A code has at most one total per interval, so none is hot.
    named = sized_join(totals, names, key, "left", even=True).withColumn(
        "copies", F.coalesce("copies", F.lit(1))
    )
    return named.groupBy("value", "interval_start").agg(
        F.sum(F.col("record_count") * F.col("copies")).alias("record_count"),
        F.sum(F.col("revenue") * F.col("copies")).cast(sum_type).alias("revenue"),
    ).select("value", "record_count", "revenue", "interval_start")


def interval_count_by_name(
    records: DataFrame,
    mapping: DataFrame,
    key: str = "PAYTYPE_515",
    width: str = INTERVAL,
    delay: str = DELAY,
) -> DataFrame:
    """``value, record_count, revenue, interval_start`` per interval and pay-type name.

    Codes without a name share one row with a null name. A table is added up per code
    before the join, so the join sees totals and not records. A stream allows no second
    aggregate over a plain key, so its records are named one by one.
    """
    aggregates = [F.count("*").alias("record_count"), F.sum(REVENUE).alias("revenue")]
    if records.isStreaming:
        renamed = mapping.select(F.col("PayType").alias(key), "value")
        named = sized_join(records, renamed, key, "left")
        return _by_interval(named, width, delay, ["value"], aggregates)
    totals = _by_interval(records, width, delay, [key], aggregates)
    sum_type = widened_sum_type(records.schema[REVENUE].dataType)
    return _report(name_totals(totals, mapping, key, sum_type), "interval_start", "value")
