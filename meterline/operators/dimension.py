"""Keyed dimension data: counters, last write per key, upsert and lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.operators.joins import fits_broadcast, sized_join
from meterline.session import cut_lineage

_OLD_KEY, _NEW_KEY = "__old_key", "__new_key"


def load_counter_columns() -> list[Column]:
    """Read, accepted and not accepted rows of a load, over its ``accepted`` flag."""
    accepted = F.count_if("accepted")
    return [
        F.count("*").alias("total"),
        accepted.alias("succeeded"),
        (F.count("*") - accepted).alias("failed"),
    ]


def load_counters(rows: DataFrame) -> DataFrame:
    return rows.agg(*load_counter_columns())


def last_write(rows: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """The row written last per key. The order columns must be unique within a key.

    An aggregate rather than a ranking, so repeated writes of one key are reduced before
    the shuffle, however many they are.
    """
    newest = F.max_by(F.struct(*columns), F.struct(*order)).alias("newest")
    return rows.groupBy(key).agg(newest).select(key, "newest.*")


def upsert(
    base: DataFrame,
    updates: DataFrame,
    key: str,
    order: list[str],
    columns: list[str],
    **limits: int,
) -> DataFrame:
    """``base`` with the last update per key replacing or joining its rows.

    ``base`` holds each key once; null is a key like any other. Few updated keys are
    broadcast and the base is not shuffled at all; many are merged by a full join of two
    sides without repeated keys. ``limits`` are passed on to ``fits_broadcast``.
    """
    latest = cut_lineage(last_write(updates, key, order, columns))
    if fits_broadcast(latest, **limits):
        updated = F.broadcast(latest.select(F.col(key).alias(_NEW_KEY)))
        same = F.col(key).eqNullSafe(F.col(_NEW_KEY))
        kept = base.select(key, *columns).join(updated, same, "left_anti")
        return kept.unionByName(latest)
    old = base.select(F.col(key).alias(_OLD_KEY), F.struct(*columns).alias("old"))
    new = latest.select(F.col(key).alias(_NEW_KEY), F.struct(*columns).alias("new"))
    merged = old.join(new, F.col(_OLD_KEY).eqNullSafe(F.col(_NEW_KEY)), "full")
    return merged.select(
        F.coalesce(_NEW_KEY, _OLD_KEY).alias(key), F.coalesce("new", "old").alias("row")
    ).select(key, "row.*")


def find(dimension: DataFrame, key: str, value: object) -> DataFrame:
    """The row of one key; exact and case-sensitive, and pushed down to the scan."""
    return dimension.filter(F.col(key) == F.lit(value))


def lookup(
    requests: DataFrame,
    dimension: DataFrame,
    request_key: str = "city",
    key: str = "name",
    how: str = "left",
    **joining: object,
) -> DataFrame:
    """Requests with the dimension's columns, as a table or a stream.

    ``left`` keeps every request and adds ``found``; ``inner`` keeps those found;
    ``left_anti`` keeps those not found, without new columns. ``joining`` is passed on to
    ``sized_join``.
    """
    keyed = dimension.withColumnRenamed(key, request_key)
    if how == "left_anti":
        return sized_join(requests, keyed.select(request_key), request_key, how, **joining)
    joined = sized_join(
        requests, keyed.withColumn("found", F.lit(True)), request_key, how, **joining
    )
    return joined.withColumn("found", F.coalesce("found", F.lit(False)))
