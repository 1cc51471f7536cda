from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.schemas import REQUEST_LOG, REQUEST_TOPIC
from meterline.sources.paths import expand_home
from meterline.sources.request_log import JSON_TIMES


def log_messages(log: DataFrame) -> DataFrame:
    """One JSON message per log record, in a ``value`` column; other columns are left out."""
    names = [name for name in REQUEST_LOG.names if name in log.columns]
    return log.select(F.to_json(F.struct(*names), JSON_TIMES).alias("value"))


def write_request_log(
    log: DataFrame,
    path: str | None = None,
    servers: str | None = None,
    topic: str = REQUEST_TOPIC,
    **connection: str,
) -> None:
    """Append the messages to a folder of JSON lines or, with ``servers``, to a topic.

    ``connection`` holds further options of the connector.
    """
    messages = log_messages(log)
    if servers:
        options = {"kafka.bootstrap.servers": servers, "topic": topic, **connection}
        messages.write.format("kafka").options(**options).save()
    else:
        messages.write.mode("append").text(expand_home(path))
