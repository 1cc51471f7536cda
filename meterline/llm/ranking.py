"""Running sums in an order of rows that is cut into ranges, so that no task gets a group whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterline.llm.columns import shuffle_partitions
from meterline.operators.ordered import COARSE_RANGES, plan_cuts, range_index

RANGE, CARRIED = "_range", "_carried"


def spread_ranges(rows: DataFrame, *order: str, ranges: int | None = None) -> tuple[DataFrame, int]:
    """``rows`` with ``_range``, the number of an even range of ``order``; and how many there are.

    The order columns must make a row unique, or equal rows share a range. As many ranges as
    the session has partitions for a shuffle, unless told otherwise. ``rows`` is read twice
    more, so it should be a written table.
    """
    total = rows.count()
    wanted = min(COARSE_RANGES, ranges or shuffle_partitions(rows))
    cuts = plan_cuts(rows, *order, rows_per_range=max(1, -(-total // wanted)), total=total)
    return rows.withColumn(RANGE, range_index(rows, order, cuts)), len(cuts) + 1


def sums_before(
    rows: DataFrame, group: str, order: tuple[str, ...], value: Column, name: str, ranges: int | None = None
) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over the rows of its group that come earlier.

    Ranges follow (group, order), so a group of any size is spread, and each range has at
    most one group that began in an earlier one: what it carries over is a row per range,
    which is broadcast.
    """
    tagged, count = spread_ranges(rows, group, *order, ranges=ranges)
    valued = tagged.withColumn("_value", value)
    totals = valued.groupBy(RANGE, group).agg(F.sum("_value").alias(CARRIED))
    earlier = W.partitionBy(group).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
    carried = totals.withColumn(CARRIED, F.sum(CARRIED).over(earlier)).filter(f"{CARRIED} is not null")
    inside = W.partitionBy(RANGE, group).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    summed = valued.repartitionById(count, F.col(RANGE)).withColumn(
        name, F.coalesce(F.sum("_value").over(inside), zero)
    )
    joined = summed.join(F.broadcast(carried), [RANGE, group], "left")
    return joined.withColumn(name, F.col(name) + F.coalesce(CARRIED, zero)).drop(RANGE, CARRIED, "_value")
