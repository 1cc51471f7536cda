from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from helpers import bag, plan, rows
from pyspark.sql import functions as F

from meterline import (
    BRIEF,
    builtin_mapping,
    daily_revenue,
    interval_count_by_name,
    interval_min_max,
    interval_revenue,
    prepare,
    preview,
    report_set,
    run_reports,
    write_report,
)
from meterline.operators import reports
from test_records import BRIEF_ROWS

THREE = [(0, "Prepaid"), (1, "Postpaid"), (2, "Corporate")]


def at(text: str) -> datetime:
    return datetime.fromisoformat(f"2021-06-22 {text}")


@pytest.fixture
def brief(spark, tmp_path):
    lines = [line.split(",") for line in BRIEF_ROWS.splitlines()[1:]]
    raw = spark.createDataFrame([(t, int(p), int(a)) for t, p, a in lines], BRIEF.schema)
    return prepare(raw, BRIEF)


@pytest.fixture
def records(spark):
    """Prepared records with edge cases: window bounds, null pay type, null revenue."""
    data = [
        ("12:14:59.999", 0, "1.000"),
        ("12:15:00", 0, "2.000"),
        ("12:15:01", 7, "3.000"),
        ("12:15:02", 8, "4.000"),
        ("12:15:03", None, "5.000"),
        ("12:15:04", 1, None),
        ("23:59:59", 1, "6.500"),
    ]
    return spark.createDataFrame(
        [(at(t), p, a and Decimal(a)) for t, p, a in data],
        "timestamp timestamp, PAYTYPE_515 int, revenue_toman decimal(6,3)",
    )


def test_brief_sample(spark, brief):
    def on(text: str) -> datetime:
        return datetime.fromisoformat(f"2023-11-05 {text}")

    assert rows(daily_revenue(brief)) == [(on("00:00").date(), 89.125)]
    assert rows(interval_revenue(brief, "PayType")) == [
        (1, 4.0, on("08:00")),
        (0, 4.0, on("08:15")),
        (2, 0.75, on("08:15")),
        (0, 0.125, on("08:30")),
        (1, 60.0, on("22:45")),
        (2, 10.25, on("22:45")),
        (0, 0.875, on("23:00")),
        (0, 9.125, on("23:45")),
    ]
    assert rows(interval_min_max(brief, "PayType"))[0] == (1, 1.5, 2.5, on("08:00"))
    named = rows(interval_count_by_name(brief, builtin_mapping(spark, THREE), "PayType"))
    assert named[:3] == [
        ("Postpaid", 2, 4.0, on("08:00")),
        ("Corporate", 1, 0.75, on("08:15")),
        ("Prepaid", 1, 4.0, on("08:15")),
    ]
    fallback = rows(interval_count_by_name(brief, builtin_mapping(spark), "PayType"))
    assert fallback[1] == (None, 1, 0.75, on("08:15"))


def test_windows_are_half_open_and_nulls_group(records):
    assert rows(interval_revenue(records)) == [
        (0, Decimal("1.000"), at("12:00")),
        (None, Decimal("5.000"), at("12:15")),
        (0, Decimal("2.000"), at("12:15")),
        (1, None, at("12:15")),
        (7, Decimal("3.000"), at("12:15")),
        (8, Decimal("4.000"), at("12:15")),
        (1, Decimal("6.500"), at("23:45")),
    ]


def test_unnamed_codes_share_one_row_and_null_revenue_counts(spark, records):
    named = rows(interval_count_by_name(records, builtin_mapping(spark)))
    assert (None, 3, Decimal("12.000"), at("12:15")) in named
    assert ("Postpaid", 1, None, at("12:15")) in named


def test_repeated_codes_count_again(spark, records):
    copies = builtin_mapping(spark, [(0, "A"), (0, "A"), (1, "B")])
    named = rows(interval_count_by_name(records, copies))
    assert ("A", 2, Decimal("4.000"), at("12:15")) in named
    renamed = copies.withColumnRenamed("PayType", "code")
    joined = records.join(renamed, F.col("PAYTYPE_515") == F.col("code"), "left")
    direct = joined.groupBy(F.window("timestamp", "15 minutes"), "value").agg(
        F.count("*").alias("n"), F.sum("revenue_toman").alias("r")
    )
    assert bag(direct.select("value", "n", "r", "window.start")) == sorted(named, key=repr)


def test_report_columns_and_types(spark, records):
    mapping = builtin_mapping(spark)
    for made in (report_set(records, mapping), None):
        if made is None:
            frames = [daily_revenue(records), interval_revenue(records), interval_min_max(records),
                      interval_count_by_name(records, mapping)]
        else:
            frames = [made.daily_revenue, made.interval_revenue, made.interval_min_max,
                      made.interval_count_by_name]
        assert [frame.dtypes for frame in frames] == [
            [("date", "date"), ("total_revenue", "decimal(16,3)")],
            [("PAYTYPE_515", "int"), ("revenue", "decimal(16,3)"), ("interval_start", "timestamp")],
            [("PAYTYPE_515", "int"), ("min_revenue", "decimal(6,3)"),
             ("max_revenue", "decimal(6,3)"), ("interval_start", "timestamp")],
            [("value", "string"), ("record_count", "bigint"), ("revenue", "decimal(16,3)"),
             ("interval_start", "timestamp")],
        ]


@pytest.mark.parametrize("zone, width", [("UTC", "15 minutes"), ("Asia/Tehran", "1 hour"),
                                         ("Asia/Kathmandu", "7 hours"), ("America/New_York", "2 days")])
def test_one_pass_equals_the_single_reports(spark, records, zone, width):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        mapping = builtin_mapping(spark, [(0, "A"), (0, "A"), (0, "C"), (1, "A")])
        made = report_set(records, mapping, width=width)
        assert rows(made.daily_revenue) == rows(daily_revenue(records))
        assert rows(made.interval_revenue) == rows(interval_revenue(records, width=width))
        assert rows(made.interval_min_max) == rows(interval_min_max(records, width=width))
        assert rows(made.interval_count_by_name) == rows(
            interval_count_by_name(records, mapping, width=width)
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_no_records(spark, records):
    none = records.limit(0)
    made = report_set(none, builtin_mapping(spark))
    assert rows(made.daily_revenue) == rows(interval_revenue(none)) == []


def test_large_mapping_is_shuffled_with_the_same_result(spark, records, monkeypatch):
    mapping = builtin_mapping(spark, THREE)
    expected = rows(interval_count_by_name(records, mapping))
    monkeypatch.setattr("meterline.operators.joins.fits_broadcast", lambda *a, **k: False)
    report = interval_count_by_name(records, mapping)
    assert "BroadcastHashJoin" not in plan(report)
    assert rows(report) == expected


def test_plans(spark, records):
    named = plan(interval_count_by_name(records, builtin_mapping(spark)))
    assert "BroadcastHashJoin LeftOuter" in named
    assert "partial_sum" in named and "CartesianProduct" not in named
    assert "TakeOrderedAndProject" in plan(preview(interval_revenue(records), 10))
    assert reports.INTERVAL == "15 minutes"


def test_written_reports(spark, records, tmp_path, capsys):
    targets = [str(tmp_path / "a"), str(tmp_path / "b")]
    run_reports(records, builtin_mapping(spark), targets, single_file=True, show=True)
    assert "interval_start" in capsys.readouterr().out
    for target in targets:
        for folder, columns in {
            "daily_revenue": "date,total_revenue",
            "revenue_15min_by_paytype": "PAYTYPE_515,revenue,interval_start",
            "revenue_15min_minmax_by_paytype": "PAYTYPE_515,min_revenue,max_revenue,interval_start",
            "revenue_count_15min_by_paytype": "value,record_count,revenue,interval_start",
        }.items():
            files = list((tmp_path / target / folder).glob("*.csv"))
            assert len(files) == 1
            lines = files[0].read_text().splitlines()
            assert lines[0] == columns and len(lines) > 1
    daily = next((tmp_path / "a" / "daily_revenue").glob("*.csv")).read_text().splitlines()
    assert daily == ["date,total_revenue", "2021-06-22,21.500"]


def test_single_file_keeps_the_order(spark, tmp_path):
    report = spark.range(5000).select(((F.col("id") * 7919) % 5003).alias("k")).orderBy("k")
    write_report(report, [str(tmp_path / "out")], single_file=True)
    (file,) = (tmp_path / "out").glob("*.csv")
    values = [int(line) for line in file.read_text().splitlines()[1:]]
    assert values == sorted(values) and len(values) == 5000
    write_report(report.limit(3), [str(tmp_path / "out")])
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 3
