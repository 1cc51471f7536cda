from __future__ import annotations

from decimal import Decimal

from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterline.functions import (
    cache_status,
    convert_amount,
    first_non_empty,
    hit_percentage,
    parse_event_time,
    strip_whitespace,
)


def test_times_that_do_not_follow_the_pattern_are_null(spark):
    texts = ["2021/06/22 12:40:34", "2021/02/30 00:00:00", "2021/6/2 1:2:3", "", None, "x",
             "2021/06/22 12:40:34 ", "12:40:34 2021/06/22", "2021/06/22 24:00:00"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    parsed = df.select("i", parse_event_time(F.col("t"), "yyyy/MM/dd HH:mm:ss").alias("p"))
    assert [i for i, p in rows(parsed.orderBy("i")) if p is not None] == [0]
    other = df.select("i", parse_event_time(F.col("t"), "HH:mm:ss yyyy/MM/dd").alias("p"))
    assert [i for i, p in rows(other.orderBy("i")) if p is not None] == [7]


def test_amounts_round_once_half_up_and_overflow_to_null(spark):
    amounts = ["25000.000", "5.000", "15.000", "0.005", "9999994.999", "9999995.000", "4.999"]
    df = spark.createDataFrame([(Decimal(a),) for a in amounts], "a decimal(10,3)")
    converted = df.select(convert_amount(F.col("a"), 10000, "decimal(6,3)"))
    expected = ["2.500", "0.001", "0.002", "0.000", "999.999", None, "0.000"]
    assert rows(converted) == [(e and Decimal(e),) for e in expected]


def test_whole_amounts_become_doubles(spark):
    df = spark.createDataFrame([(25000000,), (1,), (None,)], "a bigint")
    assert rows(df.select(convert_amount(F.col("a"), 1000, "double"))) == [
        (25000.0,),
        (0.001,),
        (None,),
    ]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0  　abÄ", max_size=8),
                min_size=20, max_size=40))
def test_strip_matches_pythons_strip(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert rows(df.select(strip_whitespace(F.col("t")))) == [(t.strip(),) for t in texts]


def test_first_non_empty_skips_null_and_empty_but_not_blank(spark):
    df = spark.createDataFrame([("", "b"), (None, "b"), (" ", "b"), ("", None)], "a string, b string")
    picked = rows(df.select(first_non_empty(F.col("a"), F.col("b"))))
    assert picked == [("b",), ("b",), (" ",), (None,)]


def test_percentages_are_exact_half_up(spark):
    cases = {(0, 0): "0.00", (1, 32): "3.13", (107, 4000): "2.68", (1, 3): "33.33",
             (2, 3): "66.67", (7, 7): "100.00", (0, 9): "0.00", (10**13, 3 * 10**13): "33.33"}
    df = spark.createDataFrame(list(cases), "h bigint, n bigint")
    got = rows(df.select(hit_percentage(F.col("h"), F.col("n"))))
    assert got == [(Decimal(text),) for text in cases.values()]


def test_cache_status(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "s boolean")
    assert rows(df.select(cache_status(F.col("s")))) == [("HIT",), ("MISS",), ("MISS",)]
