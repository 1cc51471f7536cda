from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_event_time(text: Column, pattern: str) -> Column:
    """Timestamp in the session zone; null where the text does not follow the pattern."""
    return F.try_to_timestamp(text, F.lit(pattern))


def event_date(timestamp: Column) -> Column:
    return F.to_date(timestamp)
