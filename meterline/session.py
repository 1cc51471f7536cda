"""Session settings and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SHARED_FOLDER_SETTING = "spark.checkpoint.dir"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}

# For streams with very many open windows (delay / width times the number of keys). The
# reports keep a row per interval and pay type of a day, which the default store holds.
LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app: str = "meterline", master: str | None = None, large_state: bool = False, **settings: str
) -> SparkSession:
    """A session with the settings above; ``settings`` use ``__`` for the dots of a Spark key.

    Partition counts and memory belong to the cluster and are not set here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    chosen = DEFAULTS | (LARGE_STATE if large_state else {})
    chosen |= {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in chosen.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def object_store_settings(endpoint: str, access_key: str, secret_key: str) -> dict[str, str]:
    """Settings for an S3-compatible store addressed by path, to pass on to ``config``."""
    # The names of the file system's settings.
    prefix = "spark.hadoop.fs.s3a."
    return {
        prefix + "endpoint": endpoint if "://" in endpoint else f"http://{endpoint}",
        prefix + "access.key": access_key,
        prefix + "secret.key": secret_key,
        prefix + "path.style.access": "true",
        prefix + "impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get(SHARED_FOLDER_SETTING, None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_FOLDER_SETTING} to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="meterline-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{label}-{uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once, so that later steps do not repeat its work.

    A Parquet table outlives executors as a checkpoint does, and later steps read only the
    columns they use. The folder is left to the cluster's own cleaning.
    """
    path = new_folder(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package along once, as a zip file, for Python workers to import.

    Workers of other machines do not see the driver's folders. Those of a local session do,
    if the driver runs in the package's folder or names that in PYTHONPATH.
    """
    root, context = Path(__file__).resolve().parents[1], spark.sparkContext
    known = [os.getcwd(), *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]
    one_process = context.master == "local" or context.master.startswith("local[")
    if one_process and str(root) in map(os.path.realpath, known):
        return
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="meterline-")) / "meterline.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for module in sorted((root / "meterline").rglob("*.py")):
            packed.write(module, module.relative_to(root))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
