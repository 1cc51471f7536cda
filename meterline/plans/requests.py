"""Answer a batch of lookup requests and make their log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from meterline.functions import cache_status
from meterline.operators.dimension import lookup
from meterline.operators.ordered import repeat_within, running_hit_rate
from meterline.schemas import SECONDS_TO_LIVE
from meterline.session import cut_lineage
from meterline.sinks.versions import read_latest, write_version
from meterline.sources.paths import expand_home


def answer_requests(
    requests: DataFrame, dimension: DataFrame, seconds: int = SECONDS_TO_LIVE, **cutting: int
) -> DataFrame:
    """One log row per request, found or not.

    ``requests`` has ``request_id, ts, city, response_time``; ``dimension`` has ``name,
    country_code``. A request is a hit if its city is found with a code and was also
    requested less than ``seconds`` before. The hit percentage counts the request itself.
    """
    repeats = repeat_within(requests, seconds=seconds, **cutting).drop("previous_ts")
    return rate_requests(judge_requests(repeats, dimension, requests), **cutting)


def judge_requests(repeats: DataFrame, dimension: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests that say whether they are ``repeated``, looked up and with a cache status."""
    answers = lookup(repeats, dimension, key_rows=requests, unique="request_id")
    served = F.col("found") & F.col("repeated") & (F.col("country_code") != "")
    # Cut here, or each pass of the running rate would repeat the steps above.
    return cut_lineage(answers.withColumn("cache_status", cache_status(served)).drop("repeated"))


def rate_requests(judged: DataFrame, **cutting: int) -> DataFrame:
    """The log's rows, with the running percentage of hits."""
    rated = running_hit_rate(
        judged.withColumn("hit", F.col("cache_status") == "HIT"), **cutting
    )
    return rated.select(
        "request_id",
        "ts",
        "city",
        "country_code",
        "found",
        "response_time",
        "cache_status",
        "cache_hit_percentage",
    )


class LateRequests(ValueError):
    """A load has requests that lie before the end of the log that is already rated."""


CLOSED = "load string, requests bigint, hits bigint, last_ts timestamp, last_id bigint"


def rate_load(
    log: DataFrame, load: str, rated_path: str, closed_path: str, **cutting: int
) -> dict[str, int]:
    """Add a load to a log of running rates without reading what was loaded before.

    ``log`` has ``request_id, ts, hit`` and further columns. The rated rows go to a folder of
    the load below ``rated_path``. The totals and the end of each load are a row of a small
    table of versions at ``closed_path``, which is all that the next one needs. A load that
    is repeated replaces itself if it is the newest, and is refused if it is older.
    Requests before the end of the closed log are refused as ``LateRequests``: the rates
    after them are already given out. Returns the totals with this load.
    """
    spark = log.sparkSession
    known = read_latest(spark, closed_path)
    closed = [] if known is None else sorted(known.collect(), key=lambda row: row.requests)
    earlier = [row for row in closed if row.load != load]
    if len(earlier) < len(closed) and closed[-1].load != load:
        raise ValueError(f"{load} was loaded before {closed[-1].load}")
    stored = cut_lineage(log)
    end = F.struct("ts", "request_id")
    sums = stored.agg(
        F.count("*").alias("requests"), F.count_if("hit").alias("hits"),
        F.min(end).alias("first"), F.max(end).alias("last"),
    ).first()
    before = earlier[-1] if earlier else None
    if before and sums.first and (sums.first.ts, sums.first.request_id) <= (before.last_ts, before.last_id):
        raise LateRequests(f"{load} begins at {sums.first.ts}, the log ends at {before.last_ts}")
    given = {"requests_before": before.requests, "hits_before": before.hits} if before else {}
    rated = running_hit_rate(stored, **given, **cutting)
    rated.write.mode("overwrite").parquet(f"{expand_home(rated_path)}/load={load}")
    totals = {
        "requests": sums.requests + (before.requests if before else 0),
        "hits": sums.hits + (before.hits if before else 0),
    }
    last = sums.last or (before and Row(ts=before.last_ts, request_id=before.last_id))
    if last:
        row = (load, totals["requests"], totals["hits"], last.ts, last.request_id)
        # A row for each load, of which there are few.
        write_version(spark.createDataFrame([*map(tuple, earlier), row], CLOSED), closed_path, keep=2)
    return totals
