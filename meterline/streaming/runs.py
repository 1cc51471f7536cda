"""Folders of one run of a stream: a run begins with a new checkpoint."""

from __future__ import annotations

import json
import time
from uuid import uuid4

from pyspark.sql import SparkSession

from meterline.sources.paths import expand_home

_NAME = "run-name"


def _file(spark: SparkSession, path: str):
    file = spark._jvm.org.apache.hadoop.fs.Path(expand_home(path))
    return file, file.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """``run=`` and a name that is kept with the checkpoint; later runs have later names."""
    file, files = _file(spark, f"{checkpoint}/{_NAME}")
    if not files.exists(file):
        out = files.create(file, False)
        out.write(f"run={time.time_ns():020d}-{uuid4().hex[:8]}".encode())
        out.close()
    return _text(spark, file, files)


def _text(spark: SparkSession, file, files) -> str:
    stream = files.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, note: dict) -> None:
    """A small JSON file, there whole or not at all."""
    file, files = _file(spark, path)
    folder, _, name = path.rpartition("/")
    aside, _ = _file(spark, f"{folder}/_{name}-{uuid4().hex}")
    out = files.create(aside, True)
    out.write(json.dumps(note).encode())
    out.close()
    files.delete(file, False)
    files.rename(aside, file)


def read_note(spark: SparkSession, path: str) -> dict:
    return json.loads(_text(spark, *_file(spark, path)))


def folders(
    spark: SparkSession, path: str, prefix: str, finished: bool = True, number: type = int
) -> list:
    """What follows the prefix in the names of folders, in order."""
    file, files = _file(spark, path)
    if not files.exists(file):
        return []
    found = []
    for status in files.listStatus(file):
        name = status.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith(prefix) and (not finished or files.exists(done)):
            found.append(number(name.removeprefix(prefix)))
    return sorted(found)


def entries(spark: SparkSession, path: str) -> dict[str, int]:
    """The visible files and folders in a folder, with their bytes."""
    file, files = _file(spark, path)
    if not files.exists(file):
        return {}
    found = {}
    for status in files.listStatus(file):
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            folder = status.isDirectory()
            size = files.getContentSummary(status.getPath()).getLength() if folder else status.getLen()
            found[name] = size
    return found


def remove(spark: SparkSession, path: str) -> None:
    file, files = _file(spark, path)
    files.delete(file, True)
