"""Start streaming queries, one kind per output mode.

Each query has its own checkpoint folder and resumes from it. The default trigger fires
every 30 seconds; ``trigger={"availableNow": True}`` works off what is there and ends.

The state of a report is a row per open interval and key, however many records there are.
Complete mode keeps every interval there ever was, so use it for bounded streams.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterline.schemas import REQUEST_TOPIC
from meterline.sinks.request_log import log_messages
from meterline.sinks.versions import RETIRED_SECONDS, read_latest, write_version
from meterline.sources.paths import expand_home
from meterline.streaming.runs import folders, remove, run_name

# Fixed value: the time between two micro-batches.
EVERY_30_SECONDS = {"processingTime": "30 seconds"}


def _writer(stream: DataFrame, checkpoint: str, mode: str, name: str | None, trigger: dict):
    writer = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", expand_home(checkpoint))
        .trigger(**trigger)
    )
    return writer.queryName(name) if name else writer


def start_batches(
    stream: DataFrame,
    checkpoint: str,
    mode: str,
    work: Callable[[DataFrame, int], None],
    name: str | None = None,
    trigger: dict = EVERY_30_SECONDS,
) -> StreamingQuery:
    """Hand each micro-batch to ``work``, which must bear being called twice for one."""
    return _writer(stream, checkpoint, mode, name, trigger).foreachBatch(work).start()


def stream_appended(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    form: str = "parquet",
    name: str | None = None,
    trigger: dict = EVERY_30_SECONDS,
) -> StreamingQuery:
    """Write each final row once, to files of any format Spark can append to.

    An interval is final once the watermark has passed its end, so the newest intervals
    (as many as the delay covers) are still missing.
    """
    writer = _writer(stream, checkpoint, "append", name, trigger).format(form)
    if form == "csv":
        writer = writer.option("header", True)
    return writer.start(expand_home(path))


def stream_messages(
    log: DataFrame,
    checkpoint: str,
    path: str | None = None,
    servers: str | None = None,
    topic: str = REQUEST_TOPIC,
    name: str | None = None,
    trigger: dict = EVERY_30_SECONDS,
    **connection: str,
) -> StreamingQuery:
    """Send a stream of log records to a folder of JSON lines or, with ``servers``, a topic."""
    writer = _writer(log_messages(log), checkpoint, "append", name, trigger)
    if servers:
        options = {"kafka.bootstrap.servers": servers, "topic": topic, **connection}
        return writer.format("kafka").options(**options).start()
    return writer.format("text").start(expand_home(path))


def stream_complete(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    order: list[str],
    keep: int = 2,
    min_age: float = RETIRED_SECONDS,
    name: str | None = None,
    trigger: dict = EVERY_30_SECONDS,
) -> StreamingQuery:
    """Write the whole sorted report on every trigger, as the next version below ``path``.

    A repeated batch writes the same report once more, and a new checkpoint goes on with
    the next number, so the newest version is always the current report. Of older ones,
    ``keep`` stay, and those that were replaced less than ``min_age`` seconds ago.
    """

    def replace(report: DataFrame, _: int) -> None:
        write_version(report.orderBy(*order), path, keep=keep, min_age=min_age)

    return start_batches(stream, checkpoint, "complete", replace, name, trigger)


def read_complete(spark: SparkSession, path: str) -> DataFrame | None:
    return read_latest(spark, path)


def stream_updates(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: list[str] | None = None,
    compact_every: int = 100,
    name: str | None = None,
    trigger: dict = EVERY_30_SECONDS,
) -> StreamingQuery:
    """Write the rows each trigger changed. A repeated batch replaces its own folder.

    The folders of one checkpoint lie together, so a new one starts a report of its own.
    With ``keys``, all changes are joined to one table every ``compact_every`` batches.
    """
    path = expand_home(path)
    folder = f"{path}/{run_name(stream.sparkSession, checkpoint)}"

    def keep_changes(changed: DataFrame, batch: int) -> None:
        spark = changed.sparkSession
        changed.write.mode("overwrite").parquet(f"{folder}/changes/batch={batch}")
        if keys and (batch + 1) % compact_every == 0:
            compact_updates(spark, folder, keys, batch)

    return start_batches(stream, checkpoint, "update", keep_changes, name, trigger)


def compact_updates(spark: SparkSession, folder: str, keys: list[str], batch: int) -> None:
    """Join the changes up to a batch; the folders they came from go once that is written."""
    if batch not in folders(spark, f"{folder}/joined", "batch="):
        current = _last_changes(spark, folder, keys).withColumn("batch", F.lit(batch))
        current.drop("batch").write.mode("overwrite").parquet(f"{folder}/joined/batch={batch}")
    for kind in ("changes", "joined"):
        for old in folders(spark, f"{folder}/{kind}", "batch=", finished=False):
            if old < batch or (kind == "changes" and old == batch):
                remove(spark, f"{folder}/{kind}/batch={old}")


def _last_changes(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    joined = folders(spark, f"{folder}/joined", "batch=")
    since = max(joined, default=-1)
    places = [f"{folder}/joined/batch={since}"] if joined else []
    for batch in folders(spark, f"{folder}/changes", "batch="):
        if batch > since:
            places.append(f"{folder}/changes/batch={batch}")
    numbered = F.regexp_extract(F.col("_metadata.file_path"), r"/batch=(\d+)/", 1).cast("long")
    changes = spark.read.parquet(*places).withColumn("batch", numbered)
    values = [name for name in changes.columns if name not in (*keys, "batch")]
    last = F.max_by(F.struct(*values), "batch").alias("last")
    return changes.groupBy(*keys).agg(last).select(*keys, "last.*")


def read_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The report as of now: the last change of every key, of the newest checkpoint."""
    path = expand_home(path)
    newest = max(folders(spark, path, "run=", finished=False, number=str))
    return _last_changes(spark, f"{path}/run={newest}", keys)
