from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

from meterline import object_store_settings
from meterline.session import DEFAULTS, cut_lineage, new_folder, shared_folder


class Context:
    """Just enough of a Spark context for the choice of a folder."""

    def __init__(self, master, checkpoint=None):
        self.master, self.checkpoint = master, checkpoint

    def getCheckpointDir(self):
        return self.checkpoint


class Session:
    def __init__(self, context, settings):
        self.sparkContext, self.conf = context, settings


def test_folder_named_by_the_cluster_is_used():
    session = Session(Context("spark://host:7077"), {"spark.checkpoint.dir": "hdfs:///shared"})
    assert shared_folder(session) == "hdfs:///shared"
    assert new_folder(session, "step").startswith("hdfs:///shared/step-")
    assert shared_folder(Session(Context("yarn", "hdfs:///set/by/code"), {})) == "hdfs:///set/by/code"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(Context("spark://host:7077"), {}))


def test_a_local_session_without_the_setting_gets_one_folder(tmp_path):
    """In a process of its own, because a session cannot lose the setting."""
    code = """
from meterline.session import build_session, cut_lineage, shared_folder
spark = build_session("fallback", "local[1]")
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert shared_folder(spark) == shared_folder(spark)
assert cut_lineage(spark.range(3)).count() == 3
print("kept in", shared_folder(spark))
"""
    done = subprocess.run(
        [sys.executable, "-c", code],
        env=os.environ | {"SPARK_CONF_DIR": str(tmp_path), "TMPDIR": str(tmp_path)},
        cwd=Path(__file__).parents[1],
        capture_output=True,
        text=True,
        timeout=120,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert str(tmp_path) in done.stdout


def test_settings(spark):
    assert all(spark.conf.get(name) == value for name, value in DEFAULTS.items())
    store = object_store_settings("host:9000", "user", "secret")
    assert store["spark.hadoop.fs.s3a.endpoint"] == "http://host:9000"
    assert store["spark.hadoop.fs.s3a.path.style.access"] == "true"
    kept = object_store_settings("https://store.example", "user", "secret")
    assert kept["spark.hadoop.fs.s3a.endpoint"] == "https://store.example"


def test_cut_lineage_keeps_rows_types_and_emptiness(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    cut = cut_lineage(df)
    assert cut.dtypes == df.dtypes and sorted(cut.collect()) == sorted(df.collect())
    assert cut_lineage(df.limit(0)).collect() == []
    assert "FileScan parquet" in cut._jdf.queryExecution().toString()
