from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def convert_amount(amount: Column, divisor: int, target: str) -> Column:
    """Amount in the reporting unit; null where it does not fit the target type.

    A decimal amount is divided exactly and rounded once, half up.
    """
    return (amount / F.lit(divisor)).try_cast(target)


def widened_sum_type(source: T.DataType) -> T.DataType:
    """The type ``sum`` gives for a column, needed to sum already summed values again."""
    if isinstance(source, T.DecimalType):
        return T.DecimalType(min(38, source.precision + 10), source.scale)
    if isinstance(source, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    return T.LongType()
