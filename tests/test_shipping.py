"""The package reaches Python workers that would not find it by themselves."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

JOB = """
import sys
sys.path.insert(0, {root!r})
from meterline.session import build_session, ship_package

spark = build_session("shipping", "local[2]")
ship_package(spark)
ship_package(spark)

def work(batches):
    from meterline.schemas import SECONDS_TO_LIVE
    import pyarrow as pa
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([SECONDS_TO_LIVE] * batch.num_rows)], ["n"])

print("FOUND", spark.range(1).mapInArrow(work, "n long").first()[0])
"""


def test_a_driver_elsewhere(tmp_path):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", JOB.format(root=str(ROOT))],
        cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=120,
    )
    assert "FOUND 600" in run.stdout, run.stderr[-2000:]


def test_ships_unless_workers_share_the_drivers_folder(monkeypatch):
    """A driver that runs in the package's folder says nothing about other machines."""
    from types import SimpleNamespace

    from meterline import session

    sent = []
    for number, master in enumerate(["local", "local[8]", "local-cluster[2,1,900]", "spark://h:7077", "yarn"]):
        context = SimpleNamespace(
            master=master, applicationId=f"app-{number}", addPyFile=lambda _, m=master: sent.append(m)
        )
        monkeypatch.chdir(ROOT)
        for _ in range(2):
            session.ship_package(SimpleNamespace(sparkContext=context))
    assert sent == ["local-cluster[2,1,900]", "spark://h:7077", "yarn"]
