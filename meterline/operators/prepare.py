"""From raw records to records with an event time and a converted amount."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions import convert_amount, parse_event_time
from meterline.schemas import FULL, Layout


def with_event_time(
    records: DataFrame, column: str, pattern: str, name: str = "timestamp"
) -> DataFrame:
    """Add the parsed time and drop records whose text does not follow the pattern.

    Parsing is the most expensive step of a report. A plain projection followed by the
    null filter would be planned with the parse in both of them; a generator over a
    one-element array is evaluated once and its output is filtered.
    """
    parsed = F.explode(F.array(parse_event_time(F.col(column), pattern))).alias(name)
    return records.select("*", parsed).filter(F.col(name).isNotNull())


def prepare(records: DataFrame, layout: Layout = FULL) -> DataFrame:
    """Add ``timestamp`` and ``revenue_toman``; drop records whose time cannot be parsed.

    Records whose amount does not fit are kept with a null revenue. Works on tables and
    on streams.
    """
    timed = with_event_time(records, layout.time_column, layout.time_format)
    revenue = convert_amount(F.col(layout.amount_column), layout.divisor, layout.revenue_type)
    return timed.withColumn("revenue_toman", revenue)
