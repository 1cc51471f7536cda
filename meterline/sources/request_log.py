"""The request log: JSON messages from a topic or from JSON-lines files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.schemas import REQUEST_LOG, REQUEST_TOPIC
from meterline.sources.paths import expand_home

JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def parse_log_messages(messages: DataFrame, schema: T.StructType = REQUEST_LOG) -> DataFrame:
    """Turn the ``value`` column of topic messages into log columns."""
    record = F.from_json(F.col("value").cast("string"), schema, JSON_TIMES)
    return messages.select(record.alias("record")).select("record.*")


def topic_options(servers: str, topic: str, connection: dict[str, str]) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        **connection,
    }


def read_request_log(
    spark: SparkSession,
    path: str | None = None,
    servers: str | None = None,
    topic: str = REQUEST_TOPIC,
    schema: T.StructType = REQUEST_LOG,
    **connection: str,
) -> DataFrame:
    """All log records of a folder of JSON lines or, with ``servers``, of a topic.

    Reading a topic needs the Kafka connector on the session's class path; ``connection``
    holds further options of it.
    """
    if servers:
        source = spark.read.format("kafka").options(**topic_options(servers, topic, connection))
        return parse_log_messages(source.load(), schema)
    return spark.read.schema(schema).options(**JSON_TIMES).json(expand_home(path))


def stream_request_log(
    spark: SparkSession,
    path: str | None = None,
    servers: str | None = None,
    topic: str = REQUEST_TOPIC,
    schema: T.StructType = REQUEST_LOG,
    max_files: int | None = None,
    **connection: str,
) -> DataFrame:
    """The same as a stream, from the earliest record on.

    ``max_files`` bounds a micro-batch of files; for a topic pass ``maxOffsetsPerTrigger``.
    """
    if servers:
        source = spark.readStream.format("kafka").options(**topic_options(servers, topic, connection))
        return parse_log_messages(source.load(), schema)
    reader = spark.readStream.schema(schema).options(**JSON_TIMES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(expand_home(path))
