"""A roll-up of landed days that is kept up to date: only days that changed are read again.

A manifest says for each day which files it was made from, by name, size and time, and where
its part of the roll-up lies. It is a small table of versions, so a refresh that fails or is
overtaken by another leaves the one before it whole.
"""

from __future__ import annotations

import time
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators.reports import INTERVAL
from meterline.operators.rollup import roll_up
from meterline.session import cut_lineage
from meterline.sinks.versions import (
    RETIRED_SECONDS,
    TRIES,
    VersionConflict,
    latest_version,
    read_latest,
    write_version,
)
from meterline.sources.cdr import read_landed_cdr
from meterline.sources.paths import expand_home
from meterline.streaming.runs import folders, remove

MANIFEST = "event_date date, files bigint, print string, part string"


def landed_days(spark: SparkSession, landed: str) -> DataFrame:
    """Per landed day: its number of files and a print of their names, sizes and times.

    Spark lists the files in parallel and opens none of them.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(expand_home(landed))
        .select("path", "length", "modificationTime")
    )
    day = F.to_date(F.regexp_extract("path", r"/event_date=([^/]+)/", 1).try_cast("date"))
    file = F.concat_ws(":", F.regexp_extract("path", r"([^/]+)$", 1), "length", F.unix_micros("modificationTime"))
    files = F.sort_array(F.collect_list(file))
    return (
        listed.groupBy(day.alias("event_date"))
        .agg(F.count("*").alias("files"), F.sha2(F.array_join(files, ","), 256).alias("print"))
        .filter("event_date IS NOT NULL")
    )


def refresh_roll_up(
    spark: SparkSession,
    landed: str,
    rolled: str,
    key: str = "PAYTYPE_515",
    width: str = INTERVAL,
    keep: int = 2,
    min_age: float = RETIRED_SECONDS,
) -> dict[str, int]:
    """Bring the roll-up at ``rolled`` up to date with the days landed by ``land_cdr``.

    Reads the records of new and changed days only; days that are no longer landed leave the
    roll-up. All settings must stay those of the first refresh. Returns the numbers of days
    that were read, dropped and left as they are. Parts that no kept manifest names are
    removed once they are older than ``min_age`` seconds.
    """
    place = expand_home(rolled)
    manifest = f"{place}/manifest"
    for _ in range(TRIES):
        base = latest_version(spark, manifest)
        known = read_latest(spark, manifest)
        known = spark.createDataFrame([], MANIFEST) if known is None else known
        # Days, of which there are few; written, so that they are listed once.
        now = cut_lineage(landed_days(spark, landed))
        same = now.join(known, ["event_date", "files", "print"])
        changed = [r[0] for r in now.join(same, "event_date", "left_anti").select("event_date").collect()]
        kept, before = same.count(), known.count()
        gone = known.join(now, "event_date", "left_anti").count()
        numbers = {"read": len(changed), "dropped": gone, "kept": kept}
        if base and not changed and kept == before:
            return numbers
        part = f"{time.time_ns():020d}-{uuid4().hex[:8]}"
        if changed:
            records = read_landed_cdr(spark, landed).filter(F.col("event_date").isin(changed))
            made = roll_up(records.drop("event_date"), key, width)
            made.write.parquet(f"{place}/parts/part={part}")
        new = now.filter(F.col("event_date").isin(changed)).withColumn("part", F.lit(part))
        listed = same.unionByName(new).coalesce(1).select(*known.columns)
        try:
            write_version(listed, manifest, base, keep, min_age)
        except VersionConflict:
            continue
        _remove_unnamed(spark, place, min_age)
        return numbers
    raise VersionConflict(f"{rolled} is refreshed too often by others")


def _remove_unnamed(spark: SparkSession, place: str, min_age: float) -> None:
    """Remove old parts that none of the manifests names."""
    named = set()
    for version in folders(spark, f"{place}/manifest", "version="):
        stored = spark.read.parquet(f"{place}/manifest/version={version:010d}")
        named |= {row.part for row in stored.select("part").distinct().collect()}
    for part in folders(spark, f"{place}/parts", "part=", finished=False, number=str):
        if part not in named and time.time() - int(part.split("-")[0]) / 1e9 >= min_age:
            remove(spark, f"{place}/parts/part={part}")


def read_roll_up(spark: SparkSession, rolled: str) -> DataFrame | None:
    """The roll-up as of the newest refresh, or None; ``reports_from`` makes the reports of it."""
    place = expand_home(rolled)
    manifest = read_latest(spark, f"{place}/manifest")
    if manifest is None:
        return None
    named = [row[0] for row in manifest.select("part").distinct().collect()]
    if not named:
        return None
    parts = spark.read.option("basePath", f"{place}/parts").parquet(
        *(f"{place}/parts/part={part}" for part in named)
    )
    # Of an older part, days that changed since are not in the manifest. A row for each day.
    days = F.broadcast(manifest.select(F.col("event_date").alias("date"), "part"))
    return parts.withColumn("part", F.col("part").cast("string")).join(days, ["date", "part"], "left_semi").drop("part")
