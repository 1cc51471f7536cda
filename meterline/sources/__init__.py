"""Readers for records, payment mappings, dimension files and the request log."""

from meterline.sources.cdr import read_cdr, read_landed_cdr, stream_cdr
from meterline.sources.dimension_files import read_dimension_files
from meterline.sources.mapping import builtin_mapping, load_mapping
from meterline.sources.request_log import parse_log_messages, read_request_log, stream_request_log
from meterline.sources.tables import empty_dimension, read_dimension

__all__ = [
    "builtin_mapping",
    "empty_dimension",
    "load_mapping",
    "parse_log_messages",
    "read_cdr",
    "read_dimension",
    "read_dimension_files",
    "read_landed_cdr",
    "read_request_log",
    "stream_cdr",
    "stream_request_log",
]
