"""Writers for reports, records, the request log and dimension versions."""

from meterline.sinks.records import land_cdr
from meterline.sinks.reports import preview, write_report
from meterline.sinks.request_log import log_messages, write_request_log
from meterline.sinks.versions import (
    VersionConflict,
    drop_old,
    held_table,
    merge_buckets,
    merge_table,
    merge_version,
    read_latest,
    write_changes,
    write_version,
)

__all__ = [
    "VersionConflict",
    "drop_old",
    "held_table",
    "land_cdr",
    "log_messages",
    "merge_buckets",
    "merge_table",
    "merge_version",
    "preview",
    "read_latest",
    "write_changes",
    "write_report",
    "write_request_log",
    "write_version",
]
