"""Whole streaming jobs: the four reports of one stream, and a dimension kept up to date."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterline.operators import reports
from meterline.operators.dimension import last_write, lookup, upsert
from meterline.operators.joins import sized_join
from meterline.operators.ordered import repeat_within
from meterline.operators.rollup import daily_from, roll_up
from meterline.plans.requests import judge_requests, rate_requests
from meterline.plans.revenue import FOLDERS, reports_from
from meterline.schemas import DIMENSION, SECONDS_TO_LIVE
from meterline.session import cut_lineage
from meterline.sinks.versions import (
    RETIRED_SECONDS,
    held_table,
    latest_version,
    merge_buckets,
    merge_table,
    read_touched,
    versions_of_table,
    write_changes,
)
from meterline.sources.paths import expand_home
from meterline.sources.tables import empty_dimension
from meterline.streaming.queries import EVERY_30_SECONDS, start_batches
from meterline.streaming.runs import folders, read_note, remove, run_name, write_note


def start_reports(
    records: DataFrame,
    mapping: DataFrame,
    targets: str | list[str],
    checkpoint: str,
    key: str = "PAYTYPE_515",
    width: str = reports.INTERVAL,
    delay: str = reports.DELAY,
    form: str = "csv",
    name: str | None = None,
    trigger: dict = EVERY_30_SECONDS,
) -> StreamingQuery:
    """One query that reads the stream once and writes all four reports to every target.

    It rolls the records up by date, interval and pay type; each micro-batch makes the
    reports from the rows that have become final. Intervals are written once the watermark
    has passed them. A day is written once an interval of a later day is; the rows of open
    days, a few per interval, lie beside the checkpoint. Dates are those of the session's
    zone, also where that has summer time. Files lie in one folder for each batch, which a
    repeated batch replaces; read them with ``recursiveFileLookup``.
    """
    places = [expand_home(t) for t in ([targets] if isinstance(targets, str) else targets)]
    rolled = roll_up(records, key, width, delay)
    run = run_name(records.sparkSession, checkpoint).removeprefix("run=")
    state = f"{expand_home(checkpoint)}/open-days"

    def write(report: DataFrame, folder: str, batch: int) -> None:
        stored = report.persist()
        try:
            for place in places:
                writer = stored.write.mode("overwrite").format(form)
                writer = writer.option("header", True) if form == "csv" else writer
                writer.save(f"{place}/{folder}/{run}-{batch:010d}")
        finally:
            stored.unpersist()

    def make_reports(final: DataFrame, batch: int) -> None:
        spark = final.sparkSession
        final = final.persist()
        try:
            days = final
            known = [n for n in folders(spark, state, "batch=") if n < batch]
            if known:
                before = spark.read.schema(final.schema).parquet(f"{state}/batch={known[-1]}")
                days = days.unionByName(before)
            newest = days.agg(F.max("date")).first()[0]
            still_open = days.filter(F.col("date") >= F.lit(newest)) if newest else days
            still_open.write.mode("overwrite").parquet(f"{state}/batch={batch}")
            if newest and not final.isEmpty():
                made = reports_from(final, mapping, key)
                for report, folder in FOLDERS.items():
                    if report != "daily_revenue":
                        write(getattr(made, report), folder, batch)
                closed = days.filter(F.col("date") < F.lit(newest))
                write(daily_from(closed), FOLDERS["daily_revenue"], batch)
            for old in known[:-1]:
                remove(spark, f"{state}/batch={old}")
        finally:
            final.unpersist()

    return start_batches(rolled, checkpoint, "append", make_reports, name, trigger)


def stream_upsert(
    updates: DataFrame,
    dimension_path: str | None,
    checkpoint: str,
    key: str,
    order: list[str],
    columns: list[str],
    keep: int = 2,
    compact_every: int = 20,
    table: str | None = None,
    buckets: int | None = None,
    min_age: float = RETIRED_SECONDS,
    name: str | None = None,
    trigger: dict = EVERY_30_SECONDS,
) -> StreamingQuery:
    """Merge every micro-batch into the dimension.

    Within a batch the last write by ``order`` wins, and a later batch wins over an earlier
    one. A batch that is repeated after a failure leads to the same rows again. A batch
    writes only the rows it changes, and the whole dimension every ``compact_every``
    batches. With ``buckets``, the dimension is laid out in so many, and a batch rewrites
    those that it touches. With ``table``, a table of the catalog gets a new version instead.
    Old versions are removed as ``drop_old`` says.
    """

    def merge(batch: DataFrame, _: int) -> None:
        if table:
            spark = batch.sparkSession
            merge_table(
                spark, table, lambda base: upsert(base, batch, key, order, columns), keep, min_age
            )
        elif buckets:
            merge_buckets(batch, dimension_path, key, order, columns, buckets, keep, min_age)
        elif not batch.isEmpty():
            latest = last_write(batch, key, order, columns)
            write_changes(latest, dimension_path, key, compact_every, keep, min_age)

    return start_batches(updates, checkpoint, "append", merge, name, trigger)


def start_lookups(
    requests: DataFrame,
    path: str,
    checkpoint: str,
    dimension_path: str | None = None,
    table: str | None = None,
    request_key: str = "city",
    key: str = "name",
    how: str = "left",
    form: str = "parquet",
    schema: T.StructType = DIMENSION,
    name: str | None = None,
    trigger: dict = EVERY_30_SECONDS,
    **joining: object,
) -> StreamingQuery:
    """Look every micro-batch up in the dimension as it is then, while others update it.

    A batch takes the newest version and holds it by a lease until its answers are written,
    so no writer removes files that it reads. The answers of a batch lie in a folder of
    their own, which a repeated batch replaces; read them with ``recursiveFileLookup``.
    ``joining`` is passed on to ``sized_join``, which sees a batch, not a stream.
    """
    spark = requests.sparkSession
    target = f"{expand_home(path)}/{run_name(spark, checkpoint).removeprefix('run=')}"

    def answer(batch: DataFrame, number: int) -> None:
        asked = batch.persist()
        try:
            with newest_dimension(batch.sparkSession, dimension_path, table, schema) as newest:
                answers = lookup(asked, newest, request_key, key, how, **joining)
                answers.write.mode("overwrite").format(form).save(f"{target}-{number:010d}")
        finally:
            asked.unpersist()

    return start_batches(requests, checkpoint, "append", answer, name, trigger)


@contextmanager
def newest_dimension(
    spark: SparkSession, path: str | None, table: str | None, schema: T.StructType = DIMENSION
) -> Iterator[DataFrame]:
    """The dimension as it is now, held while the block runs."""
    with held_table(spark, path or versions_of_table(spark, table)) as newest:
        if newest is None:
            newest = spark.read.table(table) if table else empty_dimension(spark, schema)
        yield newest


def start_answers(
    requests: DataFrame,
    path: str,
    checkpoint: str,
    dimension_path: str | None = None,
    table: str | None = None,
    seconds: int = SECONDS_TO_LIVE,
    buckets: int = 64,
    name: str | None = None,
    trigger: dict = EVERY_30_SECONDS,
    **cutting: int,
) -> StreamingQuery:
    """``answer_requests`` on a stream: the log's rows, with the running percentage, as they come.

    Requests of a batch count as later than those of the batches before. What a batch must
    know of these lies beside the checkpoint: the last time of each city, in a table of
    hash buckets of which a batch reads and rewrites those of its own cities, and the totals
    so far. A repeated batch starts from the state before it, also if it was ended after
    writing its own, and replaces its rows. Read them with ``recursiveFileLookup``.
    """
    target = f"{expand_home(path)}/{run_name(requests.sparkSession, checkpoint).removeprefix('run=')}"
    seen_path, totals = f"{expand_home(checkpoint)}/last-seen", f"{expand_home(checkpoint)}/totals"

    def answer(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = [n for n in folders(spark, totals, "batch=", finished=False) if n < number]
        before = read_note(spark, f"{totals}/batch={known[-1]}") if known else {}
        seen_version = before.get("seen", 0)
        asked = cut_lineage(batch)
        repeats = repeat_within(asked, seconds=seconds, **cutting)
        seen = read_touched(asked, "city", seen_path, seen_version)
        if seen is not None:
            repeats = since_last_seen(repeats, seen, seconds)
        with newest_dimension(spark, dimension_path, table) as newest:
            judged = judge_requests(repeats.drop("previous_ts"), newest, asked)
        sums = {"requests": before.get("requests", 0), "hits": before.get("hits", 0)}
        given = {f"{name}_before": n for name, n in sums.items()}
        rated = rate_requests(judged, **given, **cutting)
        rated.write.mode("overwrite").parquet(f"{target}-{number:010d}")
        if latest_version(spark, seen_path) == seen_version:
            last = asked.select("city", F.col("ts").alias("last_ts"), "request_id")
            order = ["last_ts", "request_id"]
            merge_buckets(last, seen_path, "city", order, ["last_ts"], buckets, keep=2, min_age=0)
        hit = F.count_if(F.col("cache_status") == "HIT")
        here = judged.agg(F.count("*").alias("requests"), hit.alias("hits")).first()
        sums = {name: n + here[name] for name, n in sums.items()}
        note = sums | {"seen": latest_version(spark, seen_path)}
        write_note(spark, f"{totals}/batch={number}", note)
        for old in known[:-1]:
            remove(spark, f"{totals}/batch={old}")

    return start_batches(requests, checkpoint, "append", answer, name, trigger)


def since_last_seen(repeats: DataFrame, seen: DataFrame, seconds: int) -> DataFrame:
    """Repeats that also know the last time of each city before them."""
    joined = sized_join(repeats, seen, "city", unique="request_id")
    previous = F.coalesce("previous_ts", "last_ts")
    limit = previous + F.make_dt_interval(secs=F.lit(seconds))
    repeated = F.coalesce(F.col("ts") < limit, F.lit(False))
    return joined.withColumns({"previous_ts": previous, "repeated": repeated}).drop("last_ts")
