"""Many small folders or files, one for each micro-batch, joined into few while they are read.

A manifest, a small table of versions, names the joined parts and the units that they hold.
Readers list the units first and read the manifest then: a unit that it names is read from
its part, any other from its own place, so nothing is read twice or by halves. Units and
parts that are no longer read are removed by a later run, after an age limit.
"""

from __future__ import annotations

import time
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from meterline.sinks.versions import (
    RETIRED_SECONDS,
    VersionConflict,
    latest_version,
    read_latest,
    write_version,
)
from meterline.sources.paths import expand_home
from meterline.streaming.runs import entries, remove

_JOINED = "_joined"
# kind: a part, a unit that a part holds, or a part that another one replaced.
MANIFEST = "kind string, name string, since double"
MOST_PARTS = 16
PART_BYTES = 128 << 20


def _units(spark: SparkSession, path: str, depth: int) -> dict[str, int]:
    """Names below ``path`` of all units, with their bytes; in folders of folders for depth 2."""
    found = entries(spark, path)
    if depth == 1:
        return found
    return {f"{a}/{b}": size for a in found for b, size in entries(spark, f"{path}/{a}").items()}


def _manifest(spark: SparkSession, path: str, version: int | None = None) -> list[tuple]:
    """What the manifest says: a row for each part, and each unit that is not yet removed."""
    known = read_latest(spark, f"{path}/{_JOINED}/manifest", version)
    return [] if known is None else [tuple(row) for row in known.collect()]


def _run_of(unit: str) -> str:
    return unit.rpartition("-")[0]


def _read_units(spark: SparkSession, path: str, units: list[str], form: str, schema) -> DataFrame:
    reader = spark.read.schema(schema).format(form)
    reader = reader.option("header", True) if form == "csv" else reader
    return reader.load([f"{path}/{unit}" for unit in units])


def join_batches(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    form: str = "parquet",
    least: int = 100,
    newest_stay: int = 1,
    depth: int = 1,
    min_age: float = RETIRED_SECONDS,
) -> int:
    """Join the units below ``path``, if ``least`` of them are new, and return how many were.

    The newest unit of each run stays as it is, as its batch may be repeated; give
    ``newest_stay=0`` where units are never written again. A run is what stands before the
    last hyphen of a name. If another one joins at the same time, one of the two does nothing.
    """
    path = expand_home(path)
    units = _units(spark, path, depth)
    base = latest_version(spark, f"{path}/{_JOINED}/manifest")
    rows = _manifest(spark, path, base) if base else []
    held = {name for kind, name, _ in rows if kind == "unit"}
    runs: dict[str, list[str]] = {}
    for unit in sorted(units):
        runs.setdefault(_run_of(unit), []).append(unit)
    stay = {unit for own in runs.values() for unit in own[len(own) - newest_stay :]}
    new = [unit for unit in units if unit not in held and unit not in stay]
    now = time.time()
    gone = [row for row in rows if row[0] != "part" and now - row[2] >= min_age]
    if len(new) < max(1, least):
        _remove(spark, path, gone, units)
        return 0
    parts = [row for row in rows if row[0] == "part"]
    made = _read_units(spark, path, new, form, schema)
    size = sum(units[unit] for unit in new)
    replaced = []
    if len(parts) >= MOST_PARTS:
        sizes = entries(spark, f"{path}/{_JOINED}")
        size += sum(sizes.get(name, 0) for _, name, _ in parts)
        made = made.unionByName(_read_parts(spark, path, parts, schema))
        replaced, parts = [("old", name, now) for _, name, _ in parts], []
    name = f"part-{time.time_ns():020d}-{uuid4().hex[:8]}"
    files = -(-size // PART_BYTES)
    made.coalesce(max(1, files)).write.parquet(f"{path}/{_JOINED}/{name}")
    kept = [row for row in rows if row[0] != "part" and row not in gone]
    # What is removed below stays named until it is gone.
    listed = [*parts, ("part", name, now), *kept, *gone, *replaced, *(("unit", unit, now) for unit in new)]
    listed = [row for row in listed if row[0] != "unit" or row[1] in units]
    try:
        table = spark.createDataFrame(listed, MANIFEST).coalesce(1)
        write_version(table, f"{path}/{_JOINED}/manifest", base, 2, min_age)
    except VersionConflict:
        remove(spark, f"{path}/{_JOINED}/{name}")
        return 0
    _remove(spark, path, gone, units)
    return len(new)


def _remove(spark: SparkSession, path: str, rows: list[tuple], units: dict[str, int]) -> None:
    for kind, name, _ in rows:
        if kind == "old":
            remove(spark, f"{path}/{_JOINED}/{name}")
        elif name in units:
            remove(spark, f"{path}/{name}")


def _read_parts(spark: SparkSession, path: str, parts: list[tuple], schema) -> DataFrame:
    return spark.read.schema(schema).parquet(*(f"{path}/{_JOINED}/{name}" for _, name, _ in parts))


def read_batches(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    form: str = "parquet",
    depth: int = 1,
) -> DataFrame:
    """All rows of all units below ``path``, joined or not, each once."""
    path = expand_home(path)
    units = _units(spark, path, depth)  # before the manifest is read
    rows = _manifest(spark, path)
    held = {name for kind, name, _ in rows if kind == "unit"}
    parts = [row for row in rows if row[0] == "part"]
    alone = [unit for unit in units if unit not in held]
    found = [_read_parts(spark, path, parts, schema)] if parts else []
    found += [_read_units(spark, path, alone, form, schema)] if alone else []
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)
