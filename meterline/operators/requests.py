"""Aggregates over the request log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions import hit_percentage

# Fixed value: how many of the latest keys are of interest.
RECENT = 10


def request_stats(log: DataFrame, hit: str = "hit") -> DataFrame:
    """One row: total requests, cache hits and their percentage."""
    counts = log.agg(F.count("*").alias("total_requests"), F.count_if(hit).alias("cache_hits"))
    return counts.withColumn(
        "cache_hit_percentage", hit_percentage(F.col("cache_hits"), F.col("total_requests"))
    )


def response_times(
    log: DataFrame,
    time: str = "ts",
    response: str = "response_time",
    status: str = "cache_status",
    width: str = "1 day",
    accuracy: int = 10000,
) -> DataFrame:
    """Per interval and status: requests, mean, 95th percentile and maximum.

    The percentile is approximate, off by at most ``1 / accuracy`` of the rows in rank.
    """
    return (
        log.groupBy(F.window(time, width), status)
        .agg(
            F.count("*").alias("requests"),
            F.avg(response).alias("mean_response"),
            F.percentile_approx(response, 0.95, accuracy).alias("p95_response"),
            F.max(response).alias("max_response"),
        )
        .select(
            F.col("window.start").alias("interval_start"),
            status,
            "requests",
            "mean_response",
            "p95_response",
            "max_response",
        )
    )


def response_roll_up(
    log: DataFrame,
    time: str = "ts",
    response: str = "response_time",
    status: str = "cache_status",
    width: str = "15 minutes",
    accuracy: int = 400,
) -> DataFrame:
    """Per interval and status what all later summaries need, with a sketch of the quantiles.

    Works on a stream too. The sketch holds about ``accuracy`` values at each of its levels,
    however many rows there are; its ranks are off by about ``1.3 / accuracy``.
    """
    return (
        log.groupBy(F.window(time, width), status)
        .agg(
            F.count("*").alias("requests"),
            F.sum(response).alias("total_response"),
            F.count(response).alias("responses"),
            F.max(response).alias("max_response"),
            F.kll_sketch_agg_double(response, accuracy).alias("sketch"),
        )
        .select(F.col("window.start").alias("interval_start"), status, *ROLLED_UP)
    )


ROLLED_UP = ("requests", "total_response", "responses", "max_response", "sketch")


def response_times_from(
    rolled_up: DataFrame, width: str | None = "1 day", status: str = "cache_status", rank: float = 0.95
) -> DataFrame:
    """``response_times`` of any width from a roll-up of narrower intervals.

    Sketches are merged, no request is read again. Without ``width`` there is one summary
    for each status, over all times.
    """
    wider = [] if width is None else [F.window("interval_start", width).alias("window")]
    merged = rolled_up.groupBy(*wider, status).agg(
        F.sum("requests").alias("requests"),
        (F.sum("total_response") / F.sum("responses")).alias("mean_response"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
        F.max("max_response").alias("max_response"),
    )
    start = [] if width is None else [F.col("window.start").alias("interval_start")]
    # A sketch without values has no quantile.
    quantile = F.when(
        F.kll_sketch_get_n_double("sketch") > 0,
        F.kll_sketch_get_quantile_double("sketch", F.lit(rank)),
    )
    name = f"p{round(100 * rank)}_response"
    return merged.select(
        *start, status, "requests", "mean_response", quantile.alias(name), "max_response"
    )


def _last_requests(log: DataFrame, key: str, time: str) -> DataFrame:
    return log.groupBy(key).agg(F.max(time).alias("last_request"))


def recent_keys(log: DataFrame, key: str = "city", time: str = "ts", n: int = RECENT) -> DataFrame:
    """The ``n`` keys requested last, newest first."""
    return _last_requests(log, key, time).orderBy(F.desc("last_request"), key).limit(n)


def oldest_key(log: DataFrame, key: str = "city", time: str = "ts") -> DataFrame:
    """The key whose last request lies furthest back."""
    return _last_requests(log, key, time).orderBy("last_request", key).limit(1)
