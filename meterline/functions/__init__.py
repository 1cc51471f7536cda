"""Column expressions, all of them built from Spark's own functions."""

from meterline.functions.money import convert_amount, widened_sum_type
from meterline.functions.ratios import cache_status, hit_percentage
from meterline.functions.text import first_non_empty, strip_whitespace
from meterline.functions.times import event_date, parse_event_time

__all__ = [
    "cache_status",
    "convert_amount",
    "event_date",
    "first_non_empty",
    "hit_percentage",
    "parse_event_time",
    "strip_whitespace",
    "widened_sum_type",
]
