"""Load files with differing headers and merge them into the stored dimension."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterline.operators.dimension import last_write, load_counter_columns, upsert
from meterline.schemas import DIMENSION_ALIASES
from meterline.session import cut_lineage
from meterline.sinks.versions import merge_table, merge_version
from meterline.sources.dimension_files import read_dimension_files
from meterline.sources.paths import expand_home
from meterline.sources.tables import empty_dimension

READING_ORDER = ["file_path", "block_start", "row_id"]
COUNTERS = ("total", "succeeded", "failed")


@dataclass(frozen=True)
class LoadedRows:
    accepted: DataFrame
    rejected: DataFrame
    counters: dict[str, int]


def load_dimension(
    spark: SparkSession,
    path: str,
    aliases: dict[str, tuple[str, ...]] = DIMENSION_ALIASES,
    **reading: object,
) -> LoadedRows:
    """Accepted and rejected rows of a folder, with the counters of the load.

    The files are parsed once, into the shared folder, and counted while being written.
    """
    counted = Observation("load")
    rows = read_dimension_files(spark, path, aliases, **reading)
    stored = cut_lineage(rows.observe(counted, *load_counter_columns()))
    accepted = stored.filter("accepted").drop("accepted")
    return LoadedRows(accepted, stored.filter("NOT accepted").drop("accepted"), counted.get)


def load_into(
    spark: SparkSession,
    files: str,
    dimension_path: str | None = None,
    aliases: dict[str, tuple[str, ...]] = DIMENSION_ALIASES,
    table: str | None = None,
    history: str | None = None,
    load: str | None = None,
    **reading: object,
) -> LoadedRows:
    """Load a folder and write the dimension's next version; the last row of a key wins.

    With ``table``, a table of the session's catalog is replaced instead. With ``history``,
    the counters and the rejected rows are kept there under the name ``load``, a new one
    unless given; a load of the same name replaces them.
    """
    key, *columns = aliases
    loaded = load_dimension(spark, files, aliases, **reading)
    put_rows(spark, loaded.accepted, key, READING_ORDER, columns, dimension_path, table)
    if history:
        keep_load(loaded, history, load or f"{datetime.now(UTC):%Y%m%dT%H%M%S}-{uuid4().hex[:8]}")
    return loaded


def keep_load(loaded: LoadedRows, history: str, load: str) -> None:
    """Write the rejected rows and the counters of a load, the latter last."""
    place = expand_home(history)
    loaded.rejected.write.mode("overwrite").parquet(f"{place}/rejected/load={load}")
    schema = ", ".join(f"{name} bigint" for name in COUNTERS)
    row = tuple(loaded.counters[name] for name in COUNTERS)
    counted = loaded.rejected.sparkSession.createDataFrame([row], schema)
    counted.coalesce(1).write.mode("overwrite").parquet(f"{place}/counters/load={load}")


def read_loads(spark: SparkSession, history: str) -> tuple[DataFrame, DataFrame]:
    """Counters and rejected rows of all loads that are kept, each with its load."""
    counters, rejected = (
        spark.read.parquet(f"{expand_home(history)}/{kind}").withColumn("load", F.col("load").cast("string"))
        for kind in ("counters", "rejected")
    )
    # A load that ended between the two has no counters, and so no rows yet.
    return counters, rejected.join(F.broadcast(counters.select("load")), "load", "left_semi")


def put_rows(
    spark: SparkSession,
    rows: DataFrame,
    key: str,
    order: list[str],
    columns: list[str],
    dimension_path: str | None = None,
    table: str | None = None,
) -> None:
    """Upsert rows into the stored dimension, merging again if another writer was faster."""
    if table:
        merge_table(spark, table, lambda base: upsert(base, rows, key, order, columns))
        return
    empty = empty_dimension(spark, rows.select(key, *columns).schema)
    merge_version(
        spark,
        dimension_path,
        lambda base: upsert(empty if base is None else base, rows, key, order, columns),
    )


def dimension_from(rows: DataFrame, aliases: dict[str, tuple[str, ...]] = DIMENSION_ALIASES):
    """The dimension that accepted rows alone make up."""
    key, *columns = aliases
    return last_write(rows, key, READING_ORDER, columns)
