"""A table kept as numbered versions, so that it can be rewritten while it is read.

Plain files allow no update of single rows. A version is a folder, written aside and then
renamed to the number after the one it was made from, which fails if another writer has
taken that number. A version holds the whole table, or only changed rows of a keyed table,
to be laid over the versions before it, or only some hash buckets of one, with a list that
says which earlier versions hold the others. On a file system whose rename of folders is not
atomic (some object stores), let one writer at a time write a table.

Old versions are first retired and removed later: not before an age limit, for readers that
just read, and not while a lease holds them, for readers that work longer. A reader writes
its lease first and then looks whether its version is retired; a writer retires a version
first and then looks for leases. So one of the two always sees the other.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators.dimension import last_write, upsert
from meterline.session import cut_lineage
from meterline.sources.paths import expand_home

_PREFIX = "version="
_CHANGES = "_CHANGES"
_BUCKETS = "_BUCKETS"
_BUCKET = "__bucket"
_VERSION = "__version"
TRIES = 20
# How long a version stays for readers without a lease once a newer one replaces it, and how
# long a lease holds if its reader never gives it back.
RETIRED_SECONDS = 900
LEASE_SECONDS = 6 * 3600


class VersionConflict(RuntimeError):
    """Another writer has published a version since the base was read."""


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def _files(spark: SparkSession, path: str):
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return _path(spark, expand_home(path)).getFileSystem(conf)


def _versions(spark: SparkSession, path: str, finished: bool) -> list[int]:
    files, folder = _files(spark, path), _path(spark, expand_home(path))
    if not files.exists(folder):
        return []
    found = []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith(_PREFIX) and (not finished or files.exists(done)):
            found.append(int(name.removeprefix(_PREFIX)))
    return sorted(found)


def _location(path: str, version: int) -> str:
    return f"{expand_home(path)}/{_PREFIX}{version:010d}"


def _note(spark: SparkSession, path: str, version: int, name: str) -> str | None:
    """What a small file of a version says, or None if there is none."""
    files, marker = _files(spark, path), _path(spark, _location(path, version), name)
    if not files.exists(marker):
        return None
    stream = files.open(marker)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _changed_key(spark: SparkSession, path: str, version: int) -> str | None:
    """The key of a version that holds changes, or None for one that holds the table."""
    return _note(spark, path, version, _CHANGES)


def _layout(spark: SparkSession, path: str, version: int) -> dict | None:
    """Of a version in buckets: its key, their number, and the version that holds each."""
    note = _note(spark, path, version, _BUCKETS)
    return None if note is None else json.loads(note)


def latest_version(spark: SparkSession, path: str, finished: bool = False) -> int:
    """The number to build on: of the newest version, or 0."""
    return max(_versions(spark, path, finished), default=0)


def _publish(
    table: DataFrame, path: str, number: int, notes: dict[str, str] | None = None, by: str | None = None
) -> None:
    """Write aside, then rename; raises ``VersionConflict`` if the number is taken."""
    spark, files = table.sparkSession, _files(table.sparkSession, path)
    staged = f"{expand_home(path)}/_staged-{uuid4().hex}"
    (table.write.partitionBy(by) if by else table.write).parquet(staged)
    for name, text in (notes or {}).items():
        out = files.create(_path(spark, staged, name))
        out.write(text.encode())
        out.close()
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf)
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 0)
    try:
        context.rename(_path(spark, staged), _path(spark, _location(path, number)), options)
    except Py4JJavaError as error:
        files.delete(_path(spark, staged), True)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            raise VersionConflict(f"version {number} of {path} is taken") from None
        raise


def write_version(
    table: DataFrame,
    path: str,
    base: int | None = None,
    keep: int | None = None,
    min_age: float = RETIRED_SECONDS,
) -> int:
    """Publish the table as the next version and return its number.

    With ``base``, the version that the table was made from, it fails if there is a newer
    one. Without, the table replaces whatever is there. ``keep`` retires all but that many
    whole versions, and the changes before them, once the new one is there; they are removed
    when they have been so for ``min_age`` seconds and no lease holds them.
    """
    spark = table.sparkSession
    for _ in range(TRIES):
        number = (latest_version(spark, path) if base is None else base) + 1
        try:
            _publish(table, path, number)
        except VersionConflict:
            if base is not None:
                raise
            continue
        if keep is not None:
            drop_old(spark, path, keep, min_age)
        return number
    raise VersionConflict(f"{path} is written too often by others")


def _marks(spark: SparkSession, path: str, folder: str) -> list[list[str]]:
    """The parts of the names of the empty files that a folder of marks holds."""
    files, place = _files(spark, path), _path(spark, expand_home(path), folder)
    if not files.exists(place):
        return []
    return [status.getPath().getName().split("-") for status in files.listStatus(place)]


def _mark(spark: SparkSession, path: str, folder: str, *parts: object) -> str:
    name = "-".join(map(str, parts))
    _files(spark, path).create(_path(spark, expand_home(path), folder, name), True).close()
    return name


def _unmark(spark: SparkSession, path: str, folder: str, name: str) -> None:
    _files(spark, path).delete(_path(spark, expand_home(path), folder, name), False)


def _retired(spark: SparkSession, path: str) -> dict[int, float]:
    """When each retired version was first marked so."""
    found: dict[int, float] = {}
    for version, since in _marks(spark, path, "_retired"):
        found[int(version)] = min(int(since) / 1000, found.get(int(version), float("inf")))
    return found


def _leased(spark: SparkSession, path: str) -> int | None:
    """The oldest version that a lease holds; leases past their time are cleared away."""
    oldest = None
    for parts in _marks(spark, path, "_leases"):
        if int(parts[1]) / 1000 < time.time():
            _unmark(spark, path, "_leases", "-".join(parts))
        else:
            oldest = min(int(parts[0]), int(parts[0]) if oldest is None else oldest)
    return oldest


def drop_old(spark: SparkSession, path: str, keep: int, min_age: float = RETIRED_SECONDS) -> None:
    """Retire all but ``keep`` whole versions, and remove what no reader can hold any more.

    A lease holds its version and all that it builds on. Of a version in buckets, those
    stay that a kept one still uses.
    """
    known = _versions(spark, path, finished=True)
    whole = [n for n in known if _changed_key(spark, path, n) is None]
    old = [n for n in known if whole[-keep:] and n < whole[-keep:][0]]
    since = _retired(spark, path)
    for version in old:
        if version not in since:
            since[version] = time.time()
            _mark(spark, path, "_retired", version, int(since[version] * 1000))
    # Leases are read after the marks were made.
    held = _leased(spark, path)
    # What a held version of changes is laid over must stay with it.
    first = max([n for n in whole if n <= held], default=0) if held is not None else None
    gone = [
        n for n in old if time.time() - since[n] >= min_age and (first is None or n < first)
    ]
    used = set()
    for n in known:
        if n not in gone and (layout := _layout(spark, path, n)):
            used |= {(version, int(bucket)) for bucket, version in layout["at"].items()}
    files = _files(spark, path)
    for version in gone:
        layout = _layout(spark, path, version) or {"at": {}}
        own = [int(bucket) for bucket, holder in layout["at"].items() if holder == version]
        if not any((version, bucket) in used for bucket in own):
            files.delete(_path(spark, _location(path, version)), True)
            for parts in _marks(spark, path, "_retired"):
                if int(parts[0]) == version:
                    _unmark(spark, path, "_retired", "-".join(parts))
            continue
        for bucket in own:
            if (version, bucket) not in used:
                files.delete(_path(spark, _bucket_folder(path, version, bucket)), True)


@contextmanager
def held_table(
    spark: SparkSession, path: str, seconds: float = LEASE_SECONDS
) -> Iterator[DataFrame | None]:
    """The newest table, or None; its files stay while the block runs, at most ``seconds``."""
    for _ in range(TRIES):
        version = latest_version(spark, path, finished=True)
        until = int((time.time() + seconds) * 1000)
        lease = _mark(spark, path, "_leases", version, until, uuid4().hex)
        # Of two that act at once, one sees the other: see the module's text.
        there = not version or version in _versions(spark, path, finished=True)
        if there and version not in _retired(spark, path):
            break
        _unmark(spark, path, "_leases", lease)
    else:
        raise VersionConflict(f"{path} is written too often by others")
    try:
        yield read_latest(spark, path, version)
    finally:
        _unmark(spark, path, "_leases", lease)


def merge_version(
    spark: SparkSession,
    path: str,
    merge: Callable[[DataFrame | None], DataFrame],
    keep: int | None = None,
    min_age: float = RETIRED_SECONDS,
) -> int:
    """Publish ``merge`` of the newest version, and merge again if another writer was faster."""
    for _ in range(TRIES):
        base = latest_version(spark, path)
        try:
            return write_version(merge(read_latest(spark, path)), path, base, keep, min_age)
        except VersionConflict:
            continue
    raise VersionConflict(f"{path} is written too often by others")


def write_changes(
    changes: DataFrame,
    path: str,
    key: str,
    compact_every: int = 20,
    keep: int = 2,
    min_age: float = RETIRED_SECONDS,
) -> int:
    """Publish rows that replace or join those with their key, each key once.

    Costs as much as the changes; every ``compact_every`` of them the whole table is written
    again, unless another writer publishes meanwhile.
    """
    spark = changes.sparkSession
    stored = cut_lineage(changes)
    for _ in range(TRIES):
        number = latest_version(spark, path) + 1
        try:
            _publish(stored, path, number, {_CHANGES: key})
            break
        except VersionConflict:
            continue
    else:
        raise VersionConflict(f"{path} is written too often by others")
    if len(_changes_since_whole(spark, path)[1]) >= compact_every:
        try:
            write_version(read_latest(spark, path), path, number, keep, min_age)
        except VersionConflict:
            pass  # whoever was faster will compact
    return number


def _changes_since_whole(
    spark: SparkSession, path: str, until: int | None = None
) -> tuple[int | None, list[int]]:
    """The newest whole version and the changes after it, oldest first."""
    changes: list[int] = []
    for number in reversed(_versions(spark, path, finished=True)):
        if until is not None and number > until:
            continue
        if _changed_key(spark, path, number) is None:
            return number, changes[::-1]
        changes.append(number)
    return None, changes[::-1]


def _bucket_folder(path: str, version: int, bucket: int) -> str:
    return f"{_location(path, version)}/{_BUCKET}={bucket}"


def _read_buckets(spark: SparkSession, path: str, layout: dict, wanted: list[int]) -> DataFrame | None:
    """The rows of some buckets, or None if they hold none."""
    at = layout["at"]
    places = [_bucket_folder(path, at[str(b)], b) for b in wanted if str(b) in at]
    return spark.read.parquet(*places) if places else None


def _read_whole(spark: SparkSession, path: str, version: int) -> DataFrame:
    layout = _layout(spark, path, version)
    if layout is None:
        return spark.read.parquet(_location(path, version))
    rows = _read_buckets(spark, path, layout, [*map(int, layout["at"])])
    return spark.read.parquet(_location(path, version)).drop(_BUCKET) if rows is None else rows


def read_latest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The newest whole version with all later changes, or None if there is nothing.

    With ``version``, the table as of that one.
    """
    whole, changes = _changes_since_whole(spark, path, version)
    table = None if whole is None else _read_whole(spark, path, whole)
    if not changes:
        return table
    key = _changed_key(spark, path, changes[-1])
    parts = [
        spark.read.parquet(_location(path, n)).withColumn(_VERSION, F.lit(n)) for n in changes
    ]
    changed = parts[0]
    for part in parts[1:]:
        changed = changed.unionByName(part)
    columns = [name for name in changed.columns if name not in (key, _VERSION)]
    if table is None:
        table = changed.drop(_VERSION).limit(0)
    return upsert(table, changed, key, [_VERSION], columns)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_touched(rows: DataFrame, key: str, path: str, version: int) -> DataFrame | None:
    """Of a version in buckets, those that may hold a key of ``rows``; None if there are none."""
    spark = rows.sparkSession
    layout = _layout(spark, path, version) if version else None
    if layout is None:
        return None
    touched = rows.select(bucket_of(key, layout["buckets"]).alias(_BUCKET)).distinct().collect()
    return _read_buckets(spark, path, layout, sorted(row[0] for row in touched))


def merge_buckets(
    updates: DataFrame,
    path: str,
    key: str,
    order: list[str],
    columns: list[str],
    buckets: int = 64,
    keep: int | None = None,
    min_age: float = RETIRED_SECONDS,
) -> int:
    """Upsert rows into a table laid out in hash buckets of its key; only touched ones are
    read and written.

    A version lists for every bucket the version that holds it. The number of buckets is
    that of the first such version; choose it so that one of them is a file's size. A table
    that is not in buckets yet is laid out anew as a whole. Another writer's version is
    merged into, not lost. Returns the number of the version.
    """
    spark = updates.sparkSession
    latest = cut_lineage(last_write(updates, key, order, columns))
    for _ in range(TRIES):
        number = latest_version(spark, path)
        finished = number in _versions(spark, path, finished=True)
        layout = _layout(spark, path, number) if finished else None
        count = layout["buckets"] if layout else buckets
        bucket = bucket_of(key, count).alias(_BUCKET)
        if layout:
            # At most a row for each bucket.
            touched = sorted(row[0] for row in latest.select(bucket).distinct().collect())
            if not touched:
                return number
            base = _read_buckets(spark, path, layout, touched)
        else:
            base = read_latest(spark, path)
        merged = latest if base is None else upsert(base, latest, key, [key], columns)
        rows = merged.select(key, *columns, bucket)
        tasks = min(count, int(spark.conf.get("spark.sql.shuffle.partitions")))
        stored = cut_lineage(rows.repartition(tasks, _BUCKET))
        if not layout:
            touched = sorted(row[0] for row in stored.select(_BUCKET).distinct().collect())
        at = (layout or {"at": {}})["at"] | {str(b): number + 1 for b in touched}
        note = json.dumps({"key": key, "buckets": count, "at": at})
        try:
            _publish(stored, path, number + 1, {_BUCKETS: note}, by=_BUCKET)
        except VersionConflict:
            continue
        if keep is not None:
            drop_old(spark, path, keep, min_age)
        return number + 1
    raise VersionConflict(f"{path} is written too often by others")


def _table_location(spark: SparkSession, table: str) -> str:
    return json.loads(spark.sql(f"DESCRIBE EXTENDED {table} AS JSON").first()[0])["location"]


def versions_of_table(spark: SparkSession, table: str) -> str:
    """The folder of a catalog table's versions: around its location, or beside its first one."""
    location = _table_location(spark, table).rstrip("/")
    parent, _, name = location.rpartition("/")
    return parent if name.startswith(_PREFIX) else f"{location}-versions"


def _point_to_newest(spark: SparkSession, table: str, path: str) -> None:
    """Set the table's location to its newest version, also if others do so meanwhile.

    Whoever sets it looks again afterwards, so the last to look has set the newest.
    """
    for _ in range(TRIES):
        newest = _location(path, latest_version(spark, path, finished=True))
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{newest}'")
        if newest == _location(path, latest_version(spark, path, finished=True)):
            spark.catalog.refreshTable(table)
            return
    raise VersionConflict(f"{table} is written too often by others")


def merge_table(
    spark: SparkSession,
    table: str,
    merge: Callable[[DataFrame], DataFrame],
    keep: int = 2,
    min_age: float = RETIRED_SECONDS,
) -> int:
    """Replace a table of the session's catalog by ``merge`` of it; returns the version.

    The rows go to a new version beside the table's files, whose number only one writer can
    take: one that was slower merges again, so no update is lost. Then the table's location
    is set to the newest version. Readers find the table whole at all times; a session that
    has read it before sees the new one after ``refreshTable``, as ``read_dimension`` does.
    The table must be unpartitioned Parquet. Its first files are left where they are.
    """
    if any(column.isPartition for column in spark.catalog.listColumns(table)):
        raise ValueError(f"{table} has partitions, each with a location of its own")
    columns = spark.table(table).columns
    path = versions_of_table(spark, table)

    def made(base: DataFrame | None) -> DataFrame:
        if base is None:
            spark.catalog.refreshTable(table)
            base = spark.read.table(table)
        return cut_lineage(merge(base).select(*columns))

    number = merge_version(spark, path, made, keep, min_age)
    _point_to_newest(spark, table, path)
    return number
