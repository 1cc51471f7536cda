from __future__ import annotations

import random
import re
from collections import Counter
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from helpers import bag, plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterline import (
    answer_requests,
    log_messages,
    oldest_key,
    parse_log_messages,
    rate_load,
    read_request_log,
    recent_keys,
    repeat_within,
    request_stats,
    response_roll_up,
    response_times,
    response_times_from,
    running_hit_rate,
    write_request_log,
)
from meterline.operators import ordered
from meterline.operators.ordered import _in_ranges, plan_cuts, range_index
from meterline.plans import requests as requests_plan
from meterline.plans.requests import LateRequests
from meterline.sources.request_log import topic_options

START = datetime(2024, 1, 1)
SCHEMA = "request_id long, ts timestamp, city string, hit boolean"


def percentage(hits: int, total: int) -> Decimal:
    return (Decimal(hits * 100) / Decimal(total)).quantize(Decimal("0.01"), ROUND_HALF_UP)


def expected_running(data):
    result, hits = {}, 0
    for n, (request, _, _, hit) in enumerate(sorted(data, key=lambda r: (r[1], r[0])), 1):
        hits += hit
        result[request] = (n, hits, percentage(hits, n))
    return result


def expected_repeats(data, seconds=600):
    last, result = {}, {}
    for request, ts, city, _ in sorted(data, key=lambda r: (r[1], r[0])):
        before = last.get(city)
        result[request] = (before, before is not None and ts < before + timedelta(seconds=seconds))
        last[city] = ts
    return result


def skewed(size: int, seed: int):
    """A third of the rows has one city, and a third has one and the same time."""
    rng = random.Random(seed)
    burst = START + timedelta(hours=5)
    data = []
    for i in rng.sample(range(size * 3), size):
        city = rng.choice(["hot", None if rng.random() < 0.05 else f"c{rng.randrange(40)}",
                           f"c{rng.randrange(400)}"])
        ts = burst if rng.random() < 0.33 else START + timedelta(seconds=rng.randrange(86400))
        data.append((i, ts, city, rng.random() < 0.4))
    return data


@pytest.mark.parametrize("per_range", [10_000, 700, 60, 3])
def test_running_rate_and_repeats_on_skewed_rows(spark, per_range):
    data = skewed(2500, per_range)
    log = spark.createDataFrame(data, SCHEMA).repartition(5)
    running = running_hit_rate(log, rows_per_range=per_range)
    assert running.columns == [*log.columns, "running_requests", "running_hits", "cache_hit_percentage"]
    got = {row["request_id"]: tuple(row)[4:] for row in running.collect()}
    assert got == expected_running(data)
    repeats = repeat_within(log, rows_per_range=per_range)
    got = {row["request_id"]: (row["previous_ts"], row["repeated"]) for row in repeats.collect()}
    assert got == expected_repeats(data)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.integers(0, 6), st.sampled_from(["a", "b", "", "quote\"d", "Ä\\"]), st.booleans()),
        min_size=1,
        max_size=60,
    ),
    st.integers(1, 20),
)
def test_ordered_passes_on_any_rows(spark, picks, per_range):
    data = [(i, START + timedelta(minutes=5 * m, microseconds=m), c, h)
            for i, (m, c, h) in enumerate(picks)]
    log = spark.createDataFrame(data, SCHEMA)
    running = running_hit_rate(log, rows_per_range=per_range)
    assert {r["request_id"]: tuple(r)[4:] for r in running.collect()} == expected_running(data)
    repeats = repeat_within(log, rows_per_range=per_range)
    assert {r["request_id"]: (r["previous_ts"], r["repeated"]) for r in repeats.collect()} == (
        expected_repeats(data)
    )


@pytest.mark.parametrize("order", [("ts", "request_id"), ("city", "ts", "request_id"),
                                   ("request_id",), ("hit", "ts", "request_id")])
def test_ranges_follow_the_order_and_are_even(spark, order):
    log = spark.createDataFrame(skewed(4000, 1), SCHEMA)
    cuts = plan_cuts(log, *order, rows_per_range=200)
    tagged = log.withColumn("range", range_index(log, order, cuts))
    sizes = Counter(row["range"] for row in tagged.collect())
    assert len(cuts) == 19 and set(sizes) == set(range(20))
    assert max(sizes.values()) < 2 * 200
    in_order = [row["range"] for row in tagged.orderBy(*order).collect()]
    assert in_order == sorted(in_order)


def test_the_first_list_of_cut_points_is_bounded(spark):
    log = spark.createDataFrame(skewed(300, 1), SCHEMA)
    assert len(plan_cuts(log, "ts", "request_id", rows_per_range=1, coarse_ranges=8)) == 7
    assert plan_cuts(log.limit(0), "ts", rows_per_range=1) == []


@pytest.mark.parametrize(("per_range", "coarse"), [(10, 16), (3, 5), (60, 2), (1, 7)])
def test_ranges_cut_in_two_levels(spark, per_range, coarse):
    """More ranges than one list of cut points may hold: none grows, nothing changes."""
    data = skewed(2000, per_range)
    log = spark.createDataFrame(data, SCHEMA).repartition(5)
    tagged, ranges, inner = _in_ranges(log, ("ts", "request_id"), per_range, coarse)
    assert inner > 1
    sizes = Counter(row["__range"] for row in tagged.collect())
    assert max(sizes) < ranges and max(sizes.values()) <= 2 * per_range + 1
    in_order = [row["__range"] for row in tagged.orderBy("ts", "request_id").collect()]
    assert in_order == sorted(in_order)
    cutting = {"rows_per_range": per_range, "coarse_ranges": coarse}
    running = running_hit_rate(log, **cutting)
    got = {row["request_id"]: tuple(row)[4:] for row in running.collect()}
    assert got == expected_running(data)
    repeats = repeat_within(log, **cutting)
    assert repeats.columns == [*log.columns, "previous_ts", "repeated"]
    got = {row["request_id"]: (row["previous_ts"], row["repeated"]) for row in repeats.collect()}
    assert got == expected_repeats(data)


def test_very_many_even_keys_are_not_cut(spark):
    even = spark.range(3000).select(
        F.col("id").alias("request_id"), F.timestamp_seconds("id").alias("ts"),
        F.concat(F.lit("c"), F.col("id") % 1500).alias("city"))
    text = plan(repeat_within(even, rows_per_range=20, coarse_ranges=4))
    assert "hashpartitioning(city" in text and "shufflepartitionidpassthrough" not in text


def test_hot_keys_are_cut_and_others_stay_whole(spark):
    log = spark.createDataFrame(skewed(3000, 3), SCHEMA)
    text = plan(repeat_within(log, rows_per_range=100))
    assert "shufflepartitionidpassthrough" in text
    assert "IN (hot)" in text or "= hot" in text
    even = spark.range(3000).select(
        F.col("id").alias("request_id"), F.timestamp_seconds("id").alias("ts"),
        F.concat(F.lit("c"), F.col("id") % 500).alias("city"))
    text = plan(repeat_within(even, rows_per_range=100))
    assert "hashpartitioning(city" in text and "shufflepartitionidpassthrough" not in text


def test_rows_without_a_key_may_be_the_hot_ones(spark):
    data = [(i, START + timedelta(seconds=i % 700), None if i % 3 else f"c{i % 7}", False)
            for i in range(1500)]
    log = spark.createDataFrame(data, SCHEMA)
    repeats = repeat_within(log, rows_per_range=100)
    assert "isnull(city" in plan(repeats)
    got = {row["request_id"]: (row["previous_ts"], row["repeated"]) for row in repeats.collect()}
    assert got == expected_repeats(data)


def test_search_for_carried_times_is_pushed_down(spark, tmp_path):
    spark.createDataFrame(skewed(2000, 4), SCHEMA).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert "EqualTo(city,hot)" in plan(repeat_within(log, rows_per_range=200))


def test_ordered_passes_shuffle_the_rows_once(spark):
    log = spark.createDataFrame(skewed(500, 2), SCHEMA)
    text = plan(running_hit_rate(log, rows_per_range=50))
    heavy = text.lower().count("exchange (") // 2
    assert "shufflepartitionidpassthrough" in text
    assert "BroadcastHashJoin LeftOuter" in text
    # Beside the pass-through: the totals by range, their order and their broadcast.
    assert text.count("hashpartitioning(__range") == 1 and heavy <= 4


@pytest.mark.parametrize(("per_range", "coarse"), [(3, 4096), (3, 16)])
def test_many_small_ranges_take_no_more_tasks_than_their_rows_need(spark, per_range, coarse):
    """In one level of cuts and in two; the session's 8 tasks are enough for 2,500 rows."""
    log = spark.createDataFrame(skewed(2500, 7), SCHEMA)
    cutting = {"rows_per_range": per_range, "coarse_ranges": coarse}
    for passed in (running_hit_rate(log, **cutting), repeat_within(log, **cutting)):
        dealt = re.findall(r"shufflepartitionidpassthrough\(.*?, (\d+)\)", plan(passed))
        assert dealt and set(dealt) == {"8"}


def test_running_example(spark):
    hits = [False, False, True, True]
    data = [(i, START + timedelta(seconds=i), "x", h) for i, h in enumerate(hits)]
    running = running_hit_rate(spark.createDataFrame(data, SCHEMA)).orderBy("request_id")
    assert [str(r["cache_hit_percentage"]) for r in running.collect()] == [
        "0.00", "0.00", "33.33", "50.00"
    ]


def test_ttl_is_exclusive(spark):
    seconds = [0, 600, 1199, 1199]
    data = [(i, START + timedelta(seconds=s), "x", False) for i, s in enumerate(seconds)]
    flagged = repeat_within(spark.createDataFrame(data, SCHEMA)).orderBy("request_id")
    assert [r["repeated"] for r in flagged.collect()] == [False, False, True, True]


def test_stats(spark):
    log = spark.createDataFrame([(i, START, "x", i == 0) for i in range(32)], SCHEMA)
    assert rows(request_stats(log)) == [(32, 1, Decimal("3.13"))]
    assert rows(request_stats(log.limit(0))) == [(0, 0, Decimal("0.00"))]


def test_recent_and_oldest_keys(spark):
    data = [(i, START + timedelta(minutes=i % 40), f"c{i % 15:02d}", False) for i in range(400)]
    log = spark.createDataFrame(data, SCHEMA)
    last = {}
    for _, ts, city, _ in data:
        last[city] = max(ts, last.get(city, ts))
    newest = sorted(last.items(), key=lambda p: (-p[1].timestamp(), p[0]))
    assert rows(recent_keys(log)) == newest[:10]
    assert rows(oldest_key(log)) == [min(last.items(), key=lambda p: (p[1], p[0]))]
    assert "TakeOrderedAndProject" in plan(recent_keys(log))
    assert "partial_max" in plan(recent_keys(log))


def test_response_times(spark):
    data = [(i, START + timedelta(hours=6 * (i % 8)), "HIT" if i % 2 else "MISS", i / 8)
            for i in range(400)]
    schema = "id long, ts timestamp, cache_status string, response_time double"
    log = spark.createDataFrame(data, schema)
    times = response_times(log).orderBy("interval_start", "cache_status")
    first = times.first()
    group = sorted(i / 8 for i, ts, status, _ in data if ts.day == 1 and status == "HIT")
    assert first["requests"] == len(group)
    assert first["mean_response"] == pytest.approx(sum(group) / len(group))
    assert first["max_response"] == group[-1]
    assert first["p95_response"] == group[-(-95 * len(group) // 100) - 1]


def test_answers(spark):
    dimension = spark.createDataFrame(
        [("Rome", "IT"), ("Blank", "")], "name string, country_code string"
    )
    asked = ["Rome", "Rome", "Gone", "Gone", "Blank", "Blank", "Rome"]
    data = [(i, START + timedelta(seconds=i), city, 0.5) for i, city in enumerate(asked)]
    schema = "request_id long, ts timestamp, city string, response_time double"
    requests = spark.createDataFrame(data, schema)
    for per_range in (100, 2):
        log = answer_requests(requests, dimension, rows_per_range=per_range).orderBy("request_id")
        assert [(r["country_code"], r["found"], r["cache_status"], str(r["cache_hit_percentage"]))
                for r in log.collect()] == [
            ("IT", True, "MISS", "0.00"),
            ("IT", True, "HIT", "50.00"),
            (None, False, "MISS", "33.33"),
            (None, False, "MISS", "25.00"),
            ("", True, "MISS", "20.00"),
            ("", True, "MISS", "16.67"),
            ("IT", True, "HIT", "28.57"),
        ]


def test_log_files_and_messages(spark, tmp_path):
    data = [(1, datetime(2024, 1, 1, 1, 2, 3, 456789), 'Ä "q"', 0.25, "HIT", 50.0, "extra"),
            (2, None, None, None, "MISS", 0.0, "extra")]
    log = spark.createDataFrame(
        data,
        "request_id long, ts timestamp, city string, response_time double, cache_status string, "
        "cache_hit_percentage double, other string",
    )
    expected = sorted([row[:6] for row in data], key=repr)
    path = str(tmp_path / "log")
    write_request_log(log, path)
    assert bag(read_request_log(spark, path)) == expected
    write_request_log(log, path)
    assert read_request_log(spark, path).count() == 4
    messages = log_messages(log)
    assert messages.columns == ["value"]
    as_bytes = messages.select(F.col("value").cast("binary").alias("value"))
    assert bag(parse_log_messages(as_bytes)) == expected


def test_topic_options():
    options = topic_options("host:9092", "city_requests", {"maxOffsetsPerTrigger": "9"})
    assert options == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "city_requests",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "9",
    }


def test_log_columns_not_used_are_not_parsed(spark, tmp_path):
    path = str(tmp_path / "log")
    log = spark.createDataFrame([(1, "HIT")], "request_id long, cache_status string")
    write_request_log(log, path)
    hits = read_request_log(spark, path).withColumn("hit", F.col("cache_status") == "HIT")
    assert "ReadSchema: struct<cache_status:string>" in plan(request_stats(hits))


@pytest.mark.parametrize("small", [True, False])
def test_one_key_with_all_rows_is_cut_as_a_tree(spark, monkeypatch, small):
    """No range gets more than twice its rows, also where the cut points are no small table."""
    rng = random.Random(5)
    data = [(i, START + timedelta(seconds=rng.randrange(4000)), "hot", False) for i in range(2000)]
    log = spark.createDataFrame(data, SCHEMA).repartition(5)
    if not small:
        monkeypatch.setattr(ordered, "BROADCAST_ROWS", 0)
    order = ("city", "ts", "request_id")
    tagged, ranges, inner = _in_ranges(log, order, 5, 16)
    sizes = Counter(row["__range"] for row in tagged.collect())
    assert inner > 1 and max(sizes.values()) <= 2 * 5 + 1 and len(sizes) > 300
    repeats = ordered._previous_in_ranges(log, order, 25, 8)
    got = {row["request_id"]: row["previous_ts"] for row in repeats.collect()}
    assert got == {i: previous for i, (previous, _) in expected_repeats(data).items()}
    assert ordered._some_key_fills_ranges(log, "city", 25)


def test_rates_of_loads(spark, tmp_path):
    data = sorted(skewed(900, 3), key=lambda r: (r[1], r[0]))
    cuts = [0, 300, 301, 301, 900]
    rated, closed = str(tmp_path / "rated"), str(tmp_path / "closed")
    loads = [spark.createDataFrame(data[a:b], SCHEMA) for a, b in zip(cuts, cuts[1:])]
    for number, load in enumerate(loads):
        totals = rate_load(load, f"l{number}", rated, closed, rows_per_range=100)
    assert totals == {"requests": 900, "hits": sum(h for *_, h in data)}
    again = rate_load(loads[-1], "l3", rated, closed)  # repeated after a failure
    assert again == totals
    got = {r["request_id"]: tuple(r)[4:7] for r in spark.read.parquet(rated).collect()}
    assert got == expected_running(data)
    with pytest.raises(ValueError, match="l1 was loaded before l3"):
        rate_load(loads[1], "l1", rated, closed)
    with pytest.raises(LateRequests):
        rate_load(loads[1], "l9", rated, closed)


def test_a_load_reads_no_earlier_one(spark, tmp_path, monkeypatch):
    rated, closed = str(tmp_path / "rated"), str(tmp_path / "closed")
    data = [(i, START + timedelta(seconds=i), "x", i % 3 == 0) for i in range(60)]
    rate_load(spark.createDataFrame(data[:40], SCHEMA), "a", rated, closed)
    (tmp_path / "rated" / "load=a").rename(tmp_path / "gone")
    plans = []
    running = requests_plan.running_hit_rate
    monkeypatch.setattr(
        requests_plan, "running_hit_rate", lambda *a, **o: plans.append(running(*a, **o)) or plans[-1]
    )
    rate_load(spark.createDataFrame(data[40:], SCHEMA), "b", rated, closed)
    assert "load=a" not in plan(plans[0]) and str(tmp_path / "rated") not in plan(plans[0])
    got = {r["request_id"]: tuple(r)[4:7] for r in spark.read.parquet(rated).collect()}
    assert got == {i: v for i, v in expected_running(data).items() if i >= 40}


def test_quantiles_from_merged_sketches(spark):
    rng = random.Random(2)
    data = [(START + timedelta(minutes=15 * (i % 300)), rng.expovariate(1), ("HIT", "MISS")[i % 2]) for i in range(60_000)]
    data += [(START, None, "HIT"), (START, None, "OTHER"), (None, 3.0, "HIT")]
    log = spark.createDataFrame(data, "ts timestamp, response_time double, cache_status string")
    rolled = response_roll_up(log)
    assert rolled.filter("cache_status = 'HIT'").count() <= 301
    for width in ("1 day", "30 days", None):
        times = response_times_from(rolled, width).collect()
        for row in times:
            start = row["interval_start"] if width else None
            days = {"1 day": 1, "30 days": 30, None: 10_000}[width]
            own = sorted(
                v for ts, v, s in data
                if s == row.cache_status and v is not None and (ts is not None)
                and (start is None or start <= ts < start + timedelta(days=days))
            )
            if row.cache_status == "OTHER":
                assert (row.requests, row.p95_response, row.max_response) == (1, None, None)
                continue
            assert row.max_response == own[-1] and row.mean_response == pytest.approx(sum(own) / len(own))
            rank = sum(v <= row.p95_response for v in own) / len(own)
            assert abs(rank - 0.95) < 0.01
    exact = {r.cache_status: r.requests for r in response_times_from(rolled, None).collect()}
    assert exact == {"HIT": 30_001, "MISS": 30_000, "OTHER": 1}


@pytest.mark.parametrize("order", [("ts", "request_id"), ("request_id",), ("day", "ts", "request_id"), ("big", "request_id")])
def test_grids_inside_ranges_tell_the_same_places(spark, order):
    """Equal numbers, few numbers, and numbers that span more than a grid can."""
    log = spark.createDataFrame(skewed(1500, 6), SCHEMA).withColumns(
        {"day": F.to_date("ts"), "big": F.xxhash64("request_id")}
    )
    tagged, ranges, inner = _in_ranges(log, order, 10, 6)
    assert inner > 1
    found = [row["__range"] for row in tagged.orderBy(*order).collect()]
    assert found == sorted(found) and max(Counter(found).values()) <= 2 * 10 + 1
