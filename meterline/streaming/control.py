"""Stop running queries and keep their progress."""

from __future__ import annotations

import json
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from meterline.sinks.joined import join_batches, read_batches
from meterline.sinks.versions import RETIRED_SECONDS
from meterline.sources.paths import expand_home

PROGRESS = (
    "name string, query string, run string, batch_id long, started string, input_rows long, "
    "input_rows_per_second double, processed_rows_per_second double, duration_ms long, "
    "watermark string, state_rows long, rows_dropped_late long"
)


def stop_all(spark: SparkSession) -> int:
    """Stop every running query of the session and return how many there were."""
    running = spark.streams.active
    for query in running:
        query.stop()
    return len(running)


class ProgressLog(StreamingQueryListener):
    """Writes one JSON file for each trigger of each query, in a folder for each day.

    Spark itself remembers only about the last hundred triggers.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, expand_home(path)
        self.ended: dict[str, Event] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.ended.setdefault(str(event.runId), Event())

    def onQueryProgress(self, event) -> None:  # noqa: N802
        row = progress_row(json.loads(event.progress.json))
        name = f"{row['started'][:10]}/{row['run']}-{row['batch_id']:012d}-{row['started']}.json"
        file = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name.replace(':', '')}")
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        out = file.getFileSystem(conf).create(file, True)
        out.write((json.dumps(row) + "\n").encode())
        out.close()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended.setdefault(str(event.runId), Event()).set()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Wait until all triggers of an ended query are written."""
        return self.ended.setdefault(str(query.runId), Event()).wait(seconds)


def log_progress(spark: SparkSession, path: str) -> ProgressLog:
    """Keep the progress of all queries that start from now on below ``path``."""
    listener = ProgressLog(spark, path)
    spark.streams.addListener(listener)
    return listener


def join_progress(
    spark: SparkSession, path: str, least: int = 100, min_age: float = RETIRED_SECONDS
) -> int:
    """Join the files of single triggers below ``path``; readers go on meanwhile."""
    return join_batches(spark, path, PROGRESS, "json", least, 0, 2, min_age)


def progress_row(progress: dict) -> dict:
    """One trigger. Late rows are counted after the partial aggregate: groups, not records."""
    state = progress.get("stateOperators", [])
    return {
        "name": progress.get("name"),
        "query": progress["id"],
        "run": progress["runId"],
        "batch_id": progress["batchId"],
        "started": progress["timestamp"],
        "input_rows": progress.get("numInputRows"),
        "input_rows_per_second": progress.get("inputRowsPerSecond"),
        "processed_rows_per_second": progress.get("processedRowsPerSecond"),
        "duration_ms": progress.get("durationMs", {}).get("triggerExecution"),
        "watermark": progress.get("eventTime", {}).get("watermark"),
        "state_rows": sum(operator["numRowsTotal"] for operator in state),
        "rows_dropped_late": sum(operator["numRowsDroppedByWatermark"] for operator in state),
    }


def progress_rows(spark: SparkSession, path: str, query: StreamingQuery | None = None) -> DataFrame:
    """One row per trigger, of all queries or of all runs of one, joined or not."""
    rows = read_batches(spark, path, PROGRESS, "json", depth=2)
    return rows if query is None else rows.filter(F.col("query") == str(query.id))
