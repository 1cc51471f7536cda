"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.session import ship_package

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does just that, and fast, where all text is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def hidden(df: DataFrame, prefix: str = "_in") -> tuple[DataFrame, dict[str, str]]:
    """All columns under names of our own, so that none can clash; and how they were called."""
    names = {f"{prefix}{i}": name for i, name in enumerate(df.columns)}
    return df.toDF(*names), names


def shown(df: DataFrame, names: dict[str, str], *results: str) -> DataFrame:
    """The original columns under their names, and ``results``; a result replaces a namesake."""
    kept = [F.col(k).alias(name) for k, name in names.items() if name not in results]
    return df.select(*kept, *results)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


_KEPT: list[dict] = []
_owner = ""


def keeps(cache: dict) -> None:
    """Tell of a cache that a worker fills for one operator and no other needs."""
    _KEPT.append(cache)


def begin(owner: str) -> None:
    """Empty the caches if the last task of this worker was another operator's.

    Workers live on from one step of a job to the next, and so would all that they hold.
    """
    global _owner
    if owner != _owner:
        for cache in _KEPT:
            cache.clear()
        _owner = owner


def in_batches(df: DataFrame, work: Callable, schema: T.StructType | str) -> DataFrame:
    """``df`` through a function of Arrow batches, which may use this package."""
    ship_package(df.sparkSession)
    owner = work.__module__

    def alone(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(owner)
        return work(batches)

    return df.mapInArrow(alone, schema)


def by_slices(
    batches: Iterable[pa.RecordBatch], text: str, most_bytes: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one slice holds about ``most_bytes`` of text, or one longer row."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(text)).fill_null(0).to_numpy()
        start = total = 0
        for i, n in enumerate(lengths):
            if total and total + n > most_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)
