from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def hit_percentage(hits: Column, total: Column) -> Column:
    """Hits as a percentage of the total with two decimals, half up; 0 for no requests.

    Whole-number arithmetic, so no binary fraction is ever rounded.
    """
    hundredths = F.call_function("div", hits * F.lit(20000) + total, total * F.lit(2))
    percentage = (hundredths.cast("decimal(10,0)") * F.lit(Decimal("0.01"))).cast("decimal(5,2)")
    return F.when(total > 0, percentage).otherwise(F.lit(Decimal("0.00")).cast("decimal(5,2)"))


def cache_status(served: Column) -> Column:
    return F.when(served, F.lit("HIT")).otherwise(F.lit("MISS"))
