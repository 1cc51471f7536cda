from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def documents():
    import pyarrow.parquet as pq

    return pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()


@pytest.fixture(scope="session")
def pages():
    import pyarrow.parquet as pq

    return pq.read_table(f"{FOLDER}/pages.parquet").to_pylist()


@pytest.fixture
def docs_of(spark):
    """A documents table from (doc_id, text) pairs, with columns named like inner ones."""

    def make(pairs, id_name="doc_id"):
        rows = [(i, text, "x", {"k": 1}) for i, text in pairs]
        return spark.createDataFrame(
            rows, f"{id_name} long, text string, _text string, key map<string,int>"
        )

    return make
