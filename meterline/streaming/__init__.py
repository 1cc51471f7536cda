"""Reports and lookups as Structured Streaming queries, and their control."""

from meterline.streaming.control import (
    ProgressLog,
    join_progress,
    log_progress,
    progress_rows,
    stop_all,
)
from meterline.streaming.jobs import start_answers, start_lookups, start_reports, stream_upsert
from meterline.streaming.queries import (
    read_complete,
    read_updates,
    stream_appended,
    stream_complete,
    stream_messages,
    stream_updates,
)

__all__ = [
    "ProgressLog",
    "join_progress",
    "log_progress",
    "progress_rows",
    "read_complete",
    "read_updates",
    "start_answers",
    "start_lookups",
    "start_reports",
    "stop_all",
    "stream_appended",
    "stream_complete",
    "stream_messages",
    "stream_updates",
    "stream_upsert",
]
