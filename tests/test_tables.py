"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from check_tables import open_tables, spark_side, sql_side

import __spark_entry__ as contract
from meterline.plans import on_tables


@pytest.fixture(scope="module")
def connection():
    return open_tables("/root/testdata/sf0.01")


@pytest.mark.parametrize("name", list(on_tables.QUERIES))
def test_query_equals_its_sql(spark, tables, connection, name):
    got = spark_side(spark, contract.queries()[name], tables)
    assert got == sql_side(connection, contract.oracle_sql()[name])
    assert got[1]


@pytest.mark.parametrize("name", ["stream_interval_append", "stream_upsert_last_write"])
def test_streams_of_tables_in_many_files(spark, tables, connection, tmp_path, name):
    for part in ("events", "orders", "customer"):
        source = spark.read.parquet(f"{tables}/{part}.parquet")
        source.repartition(5).write.parquet(str(tmp_path / f"{part}.parquet"))
    got = spark_side(spark, contract.queries()[name], str(tmp_path))
    assert got == sql_side(connection, contract.oracle_sql()[name])


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["value", "record_count", "revenue", "interval_start"]
    assert frame.count() > 0
