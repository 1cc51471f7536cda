"""Order-dependent passes over tables of any size and skew.

A running total has no key to partition by, and one key may hold a large share of all
rows. Both are solved by cutting the *order* into ranges of about equal size: a range can
begin and end inside a key, or between two rows of equal time. Every row gets its range
from a constant list of cut points. Since the list is a constant, a row always falls into
the same range, also when a lost task is repeated, and the cut points (taken from a
sample) decide only how even the ranges are, never what the result is. What one range must
know of the ranges before it is a table of at most a few rows per range.

Up to ``COARSE_RANGES`` ranges come from one list of cut points. Where a table needs more,
each of those is cut again at points that are found where the sample lies and kept in a
table, so the driver never holds more than the first list, and no task all points of a key.

A table is read several times here, each time only in the columns needed. If it is itself
the result of heavy work, write it first (``session.cut_lineage``).
"""

from __future__ import annotations

import json
from bisect import bisect_left, bisect_right
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions import hit_percentage
from meterline.operators.joins import BROADCAST_ROWS, fits_broadcast
from meterline.schemas import SECONDS_TO_LIVE
from meterline.session import cut_lineage

ROWS_PER_RANGE = 2_000_000
COARSE_RANGES = 4096
_SAMPLES_PER_RANGE = 40
_CELLS_PER_RANGE = 8
_RANGE = "__range"
_TASK = "__task"
_HASH = "__hash"
_GRID = ("__points", "__low", "__wide", "__below")
_JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


@dataclass(frozen=True)
class Cut:
    """One cut point: all order columns as JSON, the first as it is and as a number."""

    point: str
    first: object
    number: int | None


def _comparable(df: DataFrame, name: str) -> Column:
    """The column, or a value that sorts like it and survives a trip through JSON exactly."""
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.unix_micros(name).alias(name)
    return F.col(name)


def _as_number(df: DataFrame, name: str) -> Column:
    """A whole number that sorts like the column, or null if its type has none at hand."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.IntegralType)):
        return _comparable(df, name).cast("bigint")
    return F.lit(None).cast("bigint")


def plan_cuts(
    df: DataFrame,
    *order: str,
    rows_per_range: int = ROWS_PER_RANGE,
    coarse_ranges: int = COARSE_RANGES,
    total: int | None = None,
) -> list[Cut]:
    """Points that cut the order of ``df`` into ranges of about ``rows_per_range`` rows.

    At most ``coarse_ranges`` of them, to be cut again by ``cut_again`` where that is too
    few. Reads the order columns of a sample; the driver receives a fixed number of them per
    range.
    """
    keys = df.select(*order)
    total = keys.count() if total is None else total
    count = min(coarse_ranges, -(-total // rows_per_range))
    if count <= 1:
        return []
    share = min(1.0, count * _SAMPLES_PER_RANGE / total)
    sample = (
        keys.sample(share, seed=17)
        .orderBy(*order)
        .select(
            F.to_json(F.struct(*[_comparable(df, name) for name in order]), _JSON).alias("point"),
            F.col(order[0]).alias("first"),
            _as_number(df, order[0]).alias("number"),
        )
        .collect()
    )
    picked = sorted({len(sample) * i // count for i in range(1, count)}) if sample else []
    cuts = {sample[i]["point"]: Cut(*sample[i]) for i in picked}
    return list(cuts.values())


def cut_again(
    df: DataFrame, group: Column, order: tuple[str, ...], rows_per_range: int
) -> DataFrame:
    """``__points`` that cut each range of more than two ranges' rows, found on a sample.

    ``group`` gives the number of a row's range. One row per such range, written to the
    shared folder. The sample has a fixed number of rows per final range; only the rows of
    one group in the sample meet in one task.
    """
    share = min(1.0, _SAMPLES_PER_RANGE / rows_per_range)
    in_group = W.partitionBy(_RANGE)
    ranges = F.floor(F.col("__rows") / (rows_per_range * share))
    place = F.col("__place")
    # The row before the first and that before each further range is no cut point.
    starts = F.floor(place * ranges / F.col("__rows")) > F.floor(
        (place - 1) * ranges / F.col("__rows")
    )
    sampled = (
        df.select(*order)
        .sample(share, seed=19)
        .withColumn(_RANGE, group)
        .withColumns(
            {
                "__rows": F.count("*").over(in_group),
                "__place": F.row_number().over(in_group.orderBy(*order)) - 1,
            }
        )
    )
    point = F.struct(*[_comparable(df, name) for name in order])
    points = sampled.filter((ranges >= 2) & (place > 0) & starts).groupBy(_RANGE)
    found = points.agg(F.sort_array(F.collect_set(point)).alias("__points"))
    kind = df.schema[order[0]].dataType
    if not isinstance(kind, (T.DateType, T.TimestampType, T.IntegralType)):
        return cut_lineage(found)
    first = lambda p: F.unix_date(p[order[0]]) if isinstance(kind, T.DateType) else p[order[0]]
    numbers = F.transform("__points", lambda p: first(p).cast("bigint"))
    return cut_lineage(with_grid(cut_lineage(found.withColumn("__numbers", numbers))))


def with_grid(points: DataFrame) -> DataFrame:
    """For rows with sorted ``__numbers``: a grid over them, and how many lie below each cell.

    The grid is ``__low``, the first number, ``__wide``, the width of a cell, and ``__below``
    with one entry more than cells. All are null where the numbers span too much.
    """
    low, high = F.get("__numbers", F.lit(0)), F.element_at("__numbers", -1)
    cells = F.size("__numbers") * _CELLS_PER_RANGE
    # Halves, as the whole difference may not fit.
    fits = F.shiftright(high, 1) - F.shiftright(low, 1) < (1 << 61)
    wide = F.call_function("div", high - low, cells.cast("bigint")) + 1
    spanned = points.withColumn("__low", F.when(fits, low)).withColumn("__wide", F.when(fits, wide))
    start = lambda i: F.col("__low") + i * F.col("__wide")
    below = F.transform(
        F.sequence(F.lit(0), cells), lambda i: F.size(F.filter("__numbers", lambda v: v < start(i)))
    )
    return spanned.withColumn("__below", F.when(fits, below)).drop("__numbers")


def _constant(values: str, element: T.DataType) -> Column:
    """An array from JSON text, folded to a constant by the optimizer."""
    return F.from_json(F.lit(values), T.ArrayType(element), _JSON)


def _reached(points: Column, bounds: Column, row: Column, bits: int) -> Column:
    """How many of the sorted points lie at or below the row, by halving steps."""

    def advance(found: Column, step: Column) -> Column:
        reached = found + step
        passed = (reached <= bounds) & (F.get(points, reached - 1) <= row)
        return F.when(passed, reached).otherwise(found)

    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), advance)


def _point_index(df: DataFrame, order: tuple[str, ...], bits: int) -> Column:
    """The number of the row's own ``__points`` at or below it; 0 if it has none."""
    row = F.struct(*[_comparable(df, name) for name in order])
    points = F.col("__points")
    searched = _reached(points, F.size(points), row, bits)
    number = _as_number(df, order[0])
    if "__below" not in df.columns:
        return F.when(points.isNull(), 0).otherwise(searched)
    # As in ``range_index``: a cell without a cut point tells the place at once.
    low, wide, below = F.col("__low"), F.col("__wide"), F.col("__below")
    last = F.size(below) - 1
    cell = F.least(F.call_function("div", number - low, wide), last.cast("bigint")).cast("int")
    return (
        F.when(points.isNull(), 0)
        .when(low.isNull(), searched)
        .when(number < low, 0)
        .when(cell >= last, F.size(points))
        .when(F.get(below, cell) == F.get(below, cell + 1), F.get(below, cell))
        .otherwise(searched)
    )


def _beside(
    df: DataFrame, small: DataFrame, number: str, order: tuple[str, ...], most_rows: int, spread: int
) -> DataFrame:
    """A left join to a table of a row for each number, at most so many.

    It is broadcast if that is proven small. Otherwise the rows of a number are spread over
    ``spread`` tasks by a hash of their order, each with a copy of the number's row.
    """
    if most_rows <= BROADCAST_ROWS and fits_broadcast(small):
        return df.join(F.broadcast(small), number, "left")
    copies = small.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    salted = df.withColumn("__copy", F.pmod(F.xxhash64(*order), F.lit(spread)).cast("int"))
    return salted.join(copies, [number, "__copy"], "left").drop("__copy")


def _in_ranges(
    df: DataFrame, order: tuple[str, ...], rows_per_range: int, coarse_ranges: int
) -> tuple[DataFrame, int, int]:
    """``df`` with its range, the number of range numbers and that of ranges cut again."""
    total = df.count()
    cuts = plan_cuts(
        df, *order, rows_per_range=rows_per_range, coarse_ranges=coarse_ranges, total=total
    )
    coarse = range_index(df, order, cuts)
    tagged = df.withColumn(_RANGE, coarse)
    if -(-total // rows_per_range) <= coarse_ranges:
        return tagged, len(cuts) + 1, 1
    again = cut_again(df, coarse, order, rows_per_range)
    inner = 1 + (again.agg(F.max(F.size("__points"))).first()[0] or 0)
    joined = _beside(tagged, again, _RANGE, order, len(cuts) + 1, inner)
    number = F.col(_RANGE) * inner + _point_index(joined, order, inner.bit_length())
    ranged = joined.withColumn(_RANGE, number.cast("int")).drop(*_GRID)
    # Written, as rows are searched for their points but are read twice by what follows.
    return cut_lineage(ranged), (len(cuts) + 1) * inner, inner


def _dealt(tagged: DataFrame, ranges: int, rows_per_range: int) -> DataFrame:
    """``tagged`` dealt by ``__task``: neighbouring ranges share one while they are small.

    A task gets about ``ROWS_PER_RANGE`` rows, or less where the cluster asks for more tasks;
    a range is never parted. So the number of tasks follows the rows, not that of ranges.
    """
    usual = int(tagged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(ranges, max(usual, -(-ranges * rows_per_range // ROWS_PER_RANGE)))
    task = F.call_function("div", F.col(_RANGE).cast("bigint") * tasks, F.lit(ranges))
    return tagged.withColumn(_TASK, task.cast("int")).repartitionById(tasks, F.col(_TASK))


def range_index(df: DataFrame, order: tuple[str, ...], cuts: list[Cut]) -> Column:
    """The number of cut points at or below the row."""
    if not cuts:
        return F.lit(0)
    bounds = len(cuts)
    row = F.struct(*[_comparable(df, name) for name in order])
    point = df.select(row.alias("row")).schema["row"].dataType
    points = F.sort_array(_constant("[" + ",".join(cut.point for cut in cuts) + "]", point))
    searched = _reached(points, F.lit(bounds), row, bounds.bit_length())

    numbers = [cut.number for cut in cuts]
    if None in numbers or not 0 < numbers[-1] - numbers[0] < 1 << 62:
        return searched
    # Most rows are far from any cut point: in a grid over the first column, a cell
    # without a cut point tells the range at once. Only the others need the search.
    low, high = numbers[0], numbers[-1]
    width = -(-(high - low + 1) // (bounds * _CELLS_PER_RANGE))
    starts = range(low, high + 1, width)
    fewest = _constant(json.dumps([bisect_left(numbers, at) for at in starts]), T.IntegerType())
    most = _constant(
        json.dumps([bisect_right(numbers, at + width - 1) for at in starts]), T.IntegerType()
    )
    number = _as_number(df, order[0])
    cell = F.call_function("div", number - low, F.lit(width)).cast("int")
    return (
        F.when(number < low, 0)
        .when(number > high, bounds)
        .when(F.get(fewest, cell) == F.get(most, cell), F.get(fewest, cell))
        .otherwise(searched)
    )


def running_hit_rate(
    log: DataFrame,
    time: str = "ts",
    tie_breaker: str = "request_id",
    hit: str = "hit",
    rows_per_range: int = ROWS_PER_RANGE,
    coarse_ranges: int = COARSE_RANGES,
    requests_before: int = 0,
    hits_before: int = 0,
) -> DataFrame:
    """Per request the requests, hits and hit percentage up to and including it.

    One shuffle of the rows: they are totalled inside their range, and the totals of all
    earlier ranges (one row per range) are added. ``requests_before`` and ``hits_before``
    are those of a log that ended before this one.
    """
    order = (time, tie_breaker)
    tagged, ranges, inner = _in_ranges(log, order, rows_per_range, coarse_ranges)
    inside = W.partitionBy(_TASK, _RANGE).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    # Whole ranges in a partition, so that the window needs no shuffle of its own.
    counted = _dealt(tagged, ranges, rows_per_range).withColumns(
        {
            "running_requests": F.count("*").over(inside),
            "running_hits": F.count_if(hit).over(inside),
        }
    )
    totals = tagged.groupBy(_RANGE).agg(
        F.count("*").alias("__requests"), F.count_if(hit).alias("__hits")
    )
    before = _totals_before(totals, inner)
    requests = F.col("running_requests") + F.col("__requests") + F.lit(requests_before)
    hits = F.col("running_hits") + F.col("__hits") + F.lit(hits_before)
    small = F.broadcast(before) if ranges <= BROADCAST_ROWS else before
    return (
        counted.join(small, _RANGE, "left")
        .withColumns({"running_requests": requests, "running_hits": hits})
        .withColumn(
            "cache_hit_percentage", hit_percentage(F.col("running_hits"), F.col("running_requests"))
        )
        .drop(_RANGE, _TASK, "__requests", "__hits")
    )


def _totals_before(totals: DataFrame, inner: int) -> DataFrame:
    """Per range the sums of all ranges before it: of its own coarse range, and of earlier ones.

    One row per coarse range goes through a single task, at most ``COARSE_RANGES``.
    """
    names = ("__requests", "__hits")

    def sums_before(rows: DataFrame, window) -> DataFrame:
        sums = [F.coalesce(F.sum(n).over(window), F.lit(0)).alias(n) for n in names]
        return rows.select(*[c for c in rows.columns if c not in names], *sums)

    if inner == 1:
        return sums_before(totals, W.orderBy(_RANGE).rowsBetween(W.unboundedPreceding, -1))
    coarse = F.floor(F.col(_RANGE) / inner).cast("int").alias("__coarse")
    # Read twice below, so the rows behind it are read once.
    fine = cut_lineage(totals.select(coarse, _RANGE, *names))
    in_coarse = W.partitionBy("__coarse").orderBy(_RANGE).rowsBetween(W.unboundedPreceding, -1)
    earlier = sums_before(
        fine.groupBy("__coarse").agg(*[F.sum(n).alias(n) for n in names]),
        W.orderBy("__coarse").rowsBetween(W.unboundedPreceding, -1),
    ).select("__coarse", *[F.col(n).alias(f"{n}_before") for n in names])
    within = sums_before(fine, in_coarse).join(F.broadcast(earlier), "__coarse")
    return within.select(_RANGE, *[(F.col(n) + F.col(f"{n}_before")).alias(n) for n in names])


def repeat_within(
    log: DataFrame,
    key: str = "city",
    time: str = "ts",
    tie_breaker: str = "request_id",
    seconds: int = SECONDS_TO_LIVE,
    rows_per_range: int = ROWS_PER_RANGE,
    coarse_ranges: int = COARSE_RANGES,
) -> DataFrame:
    """Flag requests that follow one for the same key by less than ``seconds``.

    Keys of ordinary size are spread by hash, each whole. A key that fills more than a
    range is cut by time, and each of its ranges gets the last time of the one before.
    """
    order = (key, time, tie_breaker)
    total = log.count()
    ranges = -(-total // rows_per_range)
    if ranges > coarse_ranges:
        if _some_key_fills_ranges(log, key, rows_per_range):
            flagged = _previous_in_ranges(log, order, rows_per_range, coarse_ranges)
        else:
            flagged = _previous(log, order)
    else:
        planned = plan_cuts(
            log, *order, rows_per_range=rows_per_range, coarse_ranges=coarse_ranges, total=total
        )
        frequency = Counter(cut.first for cut in planned)
        cuts = [cut for cut in planned if frequency[cut.first] > 1]
        if cuts:
            whole = len(planned) + 1 - len(cuts)
            flagged = _previous_with_hot_keys(log, order, cuts, whole, rows_per_range)
        else:
            flagged = _previous(log, order)
    limit = F.col("previous_ts") + F.make_dt_interval(secs=F.lit(seconds))
    return flagged.withColumn("repeated", F.coalesce(F.col(time) < limit, F.lit(False)))


def _previous(log: DataFrame, order: tuple[str, str, str]) -> DataFrame:
    key, time, tie_breaker = order
    return log.withColumn(
        "previous_ts", F.lag(time).over(W.partitionBy(key).orderBy(time, tie_breaker))
    )


def _some_key_fills_ranges(log: DataFrame, key: str, rows_per_range: int) -> bool:
    """Whether a key has rows for two ranges or more, by a sample that is summed up per key."""
    share = min(1.0, _SAMPLES_PER_RANGE / rows_per_range)
    counts = log.select(key).sample(share, seed=19).groupBy(key).agg(F.count("*").alias("__rows"))
    return not counts.filter(F.col("__rows") >= 2 * rows_per_range * share).isEmpty()


def _previous_in_ranges(
    log: DataFrame, order: tuple[str, str, str], rows_per_range: int, coarse_ranges: int
) -> DataFrame:
    """``previous_ts`` where there are more ranges than one list of cut points can hold.

    The whole order of (key, time) is cut, first by the list and then inside each of its
    ranges, so a key may fill any number of ranges and many keys may share one. The row
    before a range is the last one of the range before: one row for each range tells it.
    Keys are in the order of a hash, a number, so that only rows of keys that are cut are
    searched for their place.
    """
    key, time, tie_breaker = order
    hashed = log.withColumn(_HASH, F.shiftright(F.xxhash64(key), 2))
    tagged, ranges, inner = _in_ranges(hashed, (_HASH, *order), rows_per_range, coarse_ranges)
    in_part = W.partitionBy(_TASK, _RANGE, key).orderBy(time, tie_breaker)
    parts = _dealt(tagged, ranges, rows_per_range)
    previous = parts.withColumn("previous_ts", F.lag(time).over(in_part))

    fields = [F.col(_HASH), F.col(key).alias("key"), F.col(time).alias("time")]
    last = F.max(F.struct(*fields)).alias("__last")
    coarse = F.floor(F.col(_RANGE) / inner).cast("int").alias("__coarse")
    ends = cut_lineage(tagged.groupBy(_RANGE).agg(last).select(coarse, _RANGE, "__last"))
    in_coarse = W.partitionBy("__coarse").orderBy(_RANGE)
    # At most ``coarse_ranges`` rows.
    earlier = ends.groupBy("__coarse").agg(F.max("__last").alias("__last")).select(
        "__coarse", F.lag("__last").over(W.orderBy("__coarse")).alias("__earlier")
    )
    before = F.coalesce(F.lag("__last").over(in_coarse), F.col("__earlier")).alias("__before")
    carried = ends.join(F.broadcast(earlier), "__coarse").select(_RANGE, before)
    joined = previous.join(F.broadcast(carried) if ranges <= BROADCAST_ROWS else carried, _RANGE)
    same_key = F.col(key).eqNullSafe(F.col("__before.key"))
    found = F.coalesce("previous_ts", F.when(same_key, F.col("__before.time")))
    return joined.withColumn("previous_ts", found).drop(_RANGE, _TASK, _HASH, "__before")


def _previous_with_hot_keys(
    log: DataFrame, order: tuple[str, str, str], cuts: list[Cut], whole: int, rows_per_range: int
) -> DataFrame:
    """``previous_ts`` with the keys of ``cuts`` cut and all others in ``whole`` ranges."""
    key, time, tie_breaker = order
    hot = {cut.first for cut in cuts}
    is_hot = F.col(key).isin([k for k in hot if k is not None])
    if None in hot:
        is_hot = is_hot | F.col(key).isNull()
    by_hash = F.pmod(F.xxhash64(key), F.lit(whole)).cast("int")
    in_range = F.lit(whole) + range_index(log, order, cuts)
    tagged = log.withColumn(_RANGE, F.when(is_hot, in_range).otherwise(by_hash))

    ranges = whole + len(cuts) + 1
    return _carried_previous(tagged, order, is_hot, ranges, rows_per_range, 2 * len(cuts))


def _carried_previous(
    tagged: DataFrame,
    order: tuple[str, str, str],
    is_hot: Column,
    ranges: int,
    rows_per_range: int,
    most: int,
) -> DataFrame:
    """``previous_ts`` inside each range, or else the last time of the key's range before."""
    key, time, tie_breaker = order
    in_part = W.partitionBy(_TASK, _RANGE, key).orderBy(time, tie_breaker)
    parts = _dealt(tagged, ranges, rows_per_range)
    previous = parts.withColumn("previous_ts", F.lag(time).over(in_part))

    # One row per hot key and range it reaches into: at most ``most``.
    last_times = tagged.filter(is_hot).groupBy(_RANGE, key).agg(F.max(time).alias("__last"))
    carried = last_times.select(
        F.col(_RANGE).alias("__carry_range"),
        F.col(key).alias("__carry_key"),
        F.lag("__last").over(W.partitionBy(key).orderBy(_RANGE)).alias("__carried"),
    )
    same = (F.col(_RANGE) == F.col("__carry_range")) & F.col(key).eqNullSafe(F.col("__carry_key"))
    return (
        previous.join(F.broadcast(carried) if most <= BROADCAST_ROWS else carried, same, "left")
        .withColumn("previous_ts", F.coalesce("previous_ts", "__carried"))
        .drop(_RANGE, _TASK, "__carry_range", "__carry_key", "__carried")
    )
