from __future__ import annotations

import json
import os
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from helpers import bag, rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from meterline import (
    FULL,
    builtin_mapping,
    daily_revenue,
    interval_count_by_name,
    interval_min_max,
    interval_revenue,
    lookup,
    prepare,
    log_progress,
    progress_rows,
    read_cdr,
    read_complete,
    read_dimension,
    read_request_log,
    read_updates,
    roll_up,
    start_reports,
    stop_all,
    stream_appended,
    stream_cdr,
    stream_complete,
    stream_messages,
    stream_request_log,
    stream_updates,
    stream_upsert,
)
from meterline.plans.revenue import FOLDERS, reports_from
from meterline.session import LARGE_STATE

AT_ONCE = {"availableNow": True}
OFTEN = {"processingTime": "1 second"}
START = datetime(2024, 1, 1)
WIDTH = timedelta(minutes=15)


def record_lines(first_hour: int, hours: int, every: int = 7) -> list[tuple[datetime, str]]:
    lines = []
    for minute in range(first_hour * 60, (first_hour + hours) * 60, every):
        ts = START + timedelta(minutes=minute)
        code = ["0", "1", "5", ""][minute % 4]
        cells = dict(zip(FULL.schema.names, [""] * 16, strict=True))
        cells |= {
            "RECORD_DATE": ts.strftime("%Y/%m/%d %H:%M:%S"),
            "PAYTYPE_515": code,
            "DEBIT_AMOUNT_42": str(10000 + 10 * minute),
        }
        lines.append((ts, ",".join(cells.values())))
    return lines


def put_file(folder, name: str, lines, age: int) -> None:
    """Write a whole file at once; the source takes files in order of their age."""
    text = "\n".join([",".join(FULL.schema.names), *[line for _, line in lines]])
    hidden = folder / f"_{name}"
    hidden.write_text(text + "\n")
    when = START.timestamp() - age
    os.utime(hidden, (when, when))
    hidden.rename(folder / name)


@pytest.fixture
def three_days(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for day in range(3):
        put_file(folder, f"day{day}.csv", record_lines(24 * day, 24), age=10 - day)
    return folder


def stream(spark, folder, max_files=1):
    return prepare(stream_cdr(spark, str(folder), max_files=max_files))


def batch(spark, folder):
    return prepare(read_cdr(spark, str(folder)))


def run_appended(spark, tmp_path, frame, form="parquet", name="out"):
    path, checkpoint = str(tmp_path / name), str(tmp_path / f"{name}-checkpoint")
    query = stream_appended(frame, path, checkpoint, form=form, trigger=AT_ONCE)
    query.awaitTermination()
    reader = spark.read.schema(frame.schema)
    return reader.option("header", True).csv(path) if form == "csv" else reader.parquet(path)


def closed(report, latest: datetime, width: timedelta = WIDTH, start="interval_start"):
    last_start = latest - timedelta(days=1) - width
    return [tuple(r) for r in report.collect() if r[start] <= last_start]


def latest_time(spark, folder) -> datetime:
    return batch(spark, folder).agg(F.max("timestamp")).first()[0]


def test_append_gives_the_closed_intervals(spark, three_days, tmp_path):
    latest = latest_time(spark, three_days)
    mapping = builtin_mapping(spark)
    for name, report in {
        "revenue": interval_revenue,
        "extremes": interval_min_max,
        "named": lambda r: interval_count_by_name(r, mapping),
    }.items():
        expected = sorted(closed(report(batch(spark, three_days)), latest), key=repr)
        got = run_appended(spark, tmp_path, report(stream(spark, three_days)), name=name)
        assert bag(got) == expected and len(expected) > 100


def test_append_with_the_store_for_large_state(spark, three_days, tmp_path):
    expected = closed(interval_revenue(batch(spark, three_days)), latest_time(spark, three_days))
    for name, value in LARGE_STATE.items():
        spark.conf.set(name, value)
    try:
        got = run_appended(spark, tmp_path, interval_revenue(stream(spark, three_days)))
    finally:
        for name in LARGE_STATE:
            spark.conf.unset(name)
    assert bag(got) == sorted(expected, key=repr)


def test_append_to_csv(spark, three_days, tmp_path):
    expected = closed(interval_revenue(batch(spark, three_days)), latest_time(spark, three_days))
    got = run_appended(spark, tmp_path, interval_revenue(stream(spark, three_days)), form="csv")
    assert bag(got) == sorted(expected, key=repr)


def test_daily_append_in_two_zones(spark, three_days, tmp_path):
    for zone, offset in (("UTC", None), ("Asia/Tehran", "20 hours 30 minutes")):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            daily = rows(daily_revenue(batch(spark, three_days)))
            frame = daily_revenue(stream(spark, three_days), day_starts=offset)
            got = run_appended(spark, tmp_path, frame, name=zone.replace("/", "-"))
            assert rows(got.orderBy("date")) == daily[:1]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_complete_and_update_equal_the_batch(spark, three_days, tmp_path):
    expected = rows(interval_min_max(batch(spark, three_days)))
    report = interval_min_max(stream(spark, three_days))
    keys = ["interval_start", "PAYTYPE_515"]
    path = str(tmp_path / "complete")
    stream_complete(
        report, path, str(tmp_path / "c1"), keys, min_age=0, trigger=AT_ONCE
    ).awaitTermination()
    assert rows(read_complete(spark, path).orderBy(*keys)) == expected
    assert len(list((tmp_path / "complete").glob("version=*"))) == 2
    path = str(tmp_path / "updates")
    stream_updates(report, path, str(tmp_path / "c2"), trigger=AT_ONCE).awaitTermination()
    current = read_updates(spark, path, keys).select("PAYTYPE_515", "min_revenue", "max_revenue",
                                                     "interval_start")
    assert rows(current.orderBy(*keys)) == expected


def test_intervals_over_two_files_are_updated(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = record_lines(0, 6)
    put_file(folder, "a.csv", lines[::2], age=2)
    put_file(folder, "b.csv", lines[1::2], age=1)
    path = str(tmp_path / "updates")
    report = interval_revenue(stream(spark, folder))
    stream_updates(report, path, str(tmp_path / "c"), trigger=AT_ONCE).awaitTermination()
    keys = ["interval_start", "PAYTYPE_515"]
    current = read_updates(spark, path, keys).select("PAYTYPE_515", "revenue", "interval_start")
    assert rows(current.orderBy(*keys)) == rows(interval_revenue(batch(spark, folder)))


def test_late_records(spark, tmp_path):
    """Newest, oldest, middle: a record is late against the watermark of the batch before."""
    folder = tmp_path / "in"
    folder.mkdir()
    newest, oldest, middle = record_lines(96, 24), record_lines(0, 24), record_lines(48, 24)
    for age, (name, lines) in enumerate([("n", newest), ("o", oldest), ("m", middle)]):
        put_file(folder, f"{name}.csv", lines, age=10 - age)
    whole = rows(interval_revenue(batch(spark, folder)))

    frame = interval_revenue(stream(spark, folder))
    path, checkpoint = str(tmp_path / "append"), str(tmp_path / "c1")
    listener = log_progress(spark, str(tmp_path / "progress"))
    query = stream_appended(frame, path, checkpoint, trigger=AT_ONCE)
    query.awaitTermination()
    assert listener.wait_for(query)
    spark.streams.removeListener(listener)
    kept = progress_rows(spark, str(tmp_path / "progress"), query)
    dropped = kept.agg(F.sum("rows_dropped_late")).first()[0]
    got = rows(spark.read.schema(frame.schema).parquet(path))
    # The second file still counts, the third is dropped, and the newest day stays open.
    cutoff = START + timedelta(hours=48)
    assert sorted(got, key=repr) == sorted([r for r in whole if r[2] < cutoff], key=repr)
    assert dropped == len([r for r in whole if cutoff <= r[2] < cutoff + timedelta(hours=24)])

    path = str(tmp_path / "complete")
    order = ["interval_start", "PAYTYPE_515"]
    stream_complete(frame, path, str(tmp_path / "c2"), order, trigger=AT_ONCE).awaitTermination()
    assert rows(read_complete(spark, path).orderBy(*order)) == whole


def test_restart_goes_on_where_the_last_run_ended(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    report = lambda: interval_revenue(stream(spark, folder))
    put_file(folder, "day0.csv", record_lines(0, 24), age=10)
    first = run_appended(spark, tmp_path, report()).count()
    put_file(folder, "day1.csv", record_lines(24, 24), age=9)
    put_file(folder, "day2.csv", record_lines(48, 24), age=8)
    second = bag(run_appended(spark, tmp_path, report()))
    again = bag(run_appended(spark, tmp_path, report()))
    uninterrupted = bag(run_appended(spark, tmp_path, report(), name="other"))
    assert first < len(second) and second == again == uninterrupted


def test_failed_batch_is_repeated_without_doubling(spark, three_days, tmp_path, monkeypatch):
    import meterline.streaming.queries as queries

    path, checkpoint = str(tmp_path / "complete"), str(tmp_path / "checkpoint")
    order = ["interval_start", "PAYTYPE_515"]
    write, calls = queries.write_version, []

    def write_then_fail(*args, **kwargs):
        write(*args, **kwargs)
        calls.append(args)
        if len(calls) == 2:
            raise OSError("lost after the write")

    monkeypatch.setattr(queries, "write_version", write_then_fail)
    report = lambda: interval_revenue(stream(spark, three_days))
    query = stream_complete(report(), path, checkpoint, order, trigger=AT_ONCE)
    with pytest.raises(StreamingQueryException, match="lost after the write"):
        query.awaitTermination()
    stream_complete(report(), path, checkpoint, order, trigger=AT_ONCE).awaitTermination()
    assert len(calls) >= 4  # the second batch was written twice
    expected = rows(interval_revenue(batch(spark, three_days)))
    assert rows(read_complete(spark, path).orderBy(*order)) == expected


def test_one_stream_for_all_reports(spark, three_days, tmp_path):
    latest = latest_time(spark, three_days)
    rolled = run_appended(spark, tmp_path, roll_up(stream(spark, three_days)))
    mapping = builtin_mapping(spark)
    made = reports_from(rolled, mapping)
    source = batch(spark, three_days)
    assert rows(made.interval_revenue) == closed(interval_revenue(source), latest)
    assert rows(made.interval_min_max) == closed(interval_min_max(source), latest)
    assert rows(made.interval_count_by_name) == closed(
        interval_count_by_name(source, mapping), latest
    )
    assert rows(made.daily_revenue)[0] == rows(daily_revenue(source))[0]


def test_large_tables_beside_a_stream(spark, three_days, tmp_path, monkeypatch):
    mapping = builtin_mapping(spark, [(0, "A"), (0, "A"), (1, "B")])
    report = interval_count_by_name(batch(spark, three_days), mapping)
    expected = closed(report, latest_time(spark, three_days))
    monkeypatch.setattr("meterline.operators.joins.fits_broadcast", lambda *a, **k: False)
    frame = interval_count_by_name(stream(spark, three_days), mapping)
    assert bag(run_appended(spark, tmp_path, frame)) == sorted(expected, key=repr)


def test_stop_all_and_progress(spark, three_days, tmp_path):
    listener = log_progress(spark, str(tmp_path / "progress"))
    queries = [
        stream_appended(interval_revenue(stream(spark, three_days)), str(tmp_path / "a"),
                        str(tmp_path / "ca"), name="revenue", trigger=OFTEN),
        stream_complete(daily_revenue(stream(spark, three_days)), str(tmp_path / "b"),
                        str(tmp_path / "cb"), ["date"], name="daily", trigger=OFTEN),
    ]
    for query in queries:
        query.processAllAvailable()
    assert stop_all(spark) == 2
    assert all(listener.wait_for(query) for query in queries)
    spark.streams.removeListener(listener)
    assert progress_rows(spark, str(tmp_path / "progress")).select("query").distinct().count() == 2
    progress = progress_rows(spark, str(tmp_path / "progress"), queries[0])
    assert progress.agg(F.sum("input_rows")).first()[0] == batch(spark, three_days).count()
    first = progress.orderBy("batch_id").first()
    assert first["name"] == "revenue" and first["state_rows"] > 0 and first["watermark"]
    assert spark.streams.active == [] and stop_all(spark) == 0


def test_log_streams(spark, tmp_path):
    cities = spark.createDataFrame([("c1", "X"), ("c2", "Y")], "name string, country_code string")
    log = spark.createDataFrame(
        [(i, START + timedelta(seconds=i), f"c{i % 4}", 0.5, "MISS", 0.0) for i in range(40)],
        "request_id long, ts timestamp, city string, response_time double, cache_status string, "
        "cache_hit_percentage double",
    )
    source, copied = str(tmp_path / "log"), str(tmp_path / "copy")
    from meterline import write_request_log

    write_request_log(log, source)
    for path, limits in ((copied, {}), (copied + "2", {"max_rows": 0})):
        answers = lookup(stream_request_log(spark, source, max_files=1), cities, **limits)
        query = stream_messages(answers, path + "-checkpoint", path=path, trigger=AT_ONCE)
        query.awaitTermination()
        assert bag(read_request_log(spark, path)) == bag(log)


def test_stream_upsert_goes_on_after_a_failure(spark, tmp_path, monkeypatch):
    import meterline.streaming.jobs as jobs

    schema = "name string, country_code string, seq long"
    folder, path, checkpoint = (str(tmp_path / name) for name in ("in", "stored", "checkpoint"))
    batches = [[("A", "1", 1), ("B", "1", 2), ("A", "2", 3)], [("B", "2", 1), ("C", "1", 1)]]
    for batch_rows in batches:
        spark.createDataFrame(batch_rows, schema).coalesce(1).write.mode("append").json(folder)
    for number, file in enumerate(sorted((tmp_path / "in").glob("*.json"), key=os.path.getmtime)):
        os.utime(file, (START.timestamp() + number, START.timestamp() + number))

    def run():
        updates = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)
        stream_upsert(
            updates, path, checkpoint, "name", ["seq"], ["country_code"], trigger=AT_ONCE
        ).awaitTermination()

    write = jobs.write_changes

    def write_then_fail(*args, **kwargs):
        write(*args, **kwargs)
        raise OSError("lost after the write")

    monkeypatch.setattr(jobs, "write_changes", write_then_fail)
    with pytest.raises(StreamingQueryException, match="lost after the write"):
        run()
    monkeypatch.setattr(jobs, "write_changes", write)
    run()
    assert dict(rows(read_dimension(spark, path))) == {"A": "2", "B": "2", "C": "1"}
    run()
    assert read_dimension(spark, path).count() == 3


def read_report(spark, place, name, schema):
    reader = spark.read.schema(schema).option("recursiveFileLookup", True)
    return reader.parquet(f"{place}/{FOLDERS[name]}")


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tehran", "Europe/Berlin"])
def test_four_reports_of_one_stream_at_two_targets(spark, tmp_path, zone):
    """In every zone, through a change to summer time too, the stream's rows are the batch's."""
    folder = tmp_path / "in"
    folder.mkdir()
    first = (datetime(2024, 3, 29) - START).days * 24
    for day in range(5):
        put_file(folder, f"day{day}.csv", record_lines(first + 24 * day, 24), age=10 - day)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        mapping, targets = builtin_mapping(spark), [str(tmp_path / "a"), str(tmp_path / "b")]

        def run():
            query = start_reports(stream(spark, folder), mapping, targets, str(tmp_path / "state"),
                                  form="parquet", trigger=AT_ONCE)
            query.awaitTermination()
            return query

        query = run()
        made = {r["sources"][0]["numInputRows"] for r in map(json.loads, (p.json for p in query.recentProgress))}
        source = batch(spark, folder)
        assert sum(p.numInputRows for p in query.recentProgress) == source.count() and made
        latest = source.agg(F.max("timestamp")).first()[0]
        whole = {
            "interval_revenue": interval_revenue(source),
            "interval_min_max": interval_min_max(source),
            "interval_count_by_name": interval_count_by_name(source, mapping),
        }
        days = daily_revenue(source)
        for _ in range(2):
            for target in targets:
                for name, report in whole.items():
                    got = read_report(spark, target, name, report.schema)
                    assert bag(got) == sorted(closed(report, latest), key=repr)
                got = rows(read_report(spark, target, "daily_revenue", days.schema).orderBy("date"))
                assert got == rows(days)[: len(got)] and len(got) >= 3
            run()  # nothing new: nothing changes
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_repeated_batch_of_reports_replaces_itself(spark, three_days, tmp_path, monkeypatch):
    import meterline.streaming.jobs as jobs

    state, target = str(tmp_path / "state"), str(tmp_path / "out")
    remove, calls = jobs.daily_from, []

    def fail_once(days):
        calls.append(days)
        if len(calls) == 2:
            raise OSError("lost before the last report")
        return remove(days)

    monkeypatch.setattr(jobs, "daily_from", fail_once)

    def run():
        start_reports(stream(spark, three_days), builtin_mapping(spark), target, state,
                      form="parquet", trigger=AT_ONCE).awaitTermination()

    with pytest.raises(StreamingQueryException, match="lost before the last report"):
        run()
    run()
    report = interval_revenue(batch(spark, three_days))
    got = read_report(spark, target, "interval_revenue", report.schema)
    assert bag(got) == sorted(closed(report, latest_time(spark, three_days)), key=repr)


def test_streamed_days_of_a_zone_need_its_offset(spark, three_days):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="day_starts"):
            daily_revenue(stream(spark, three_days))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_new_checkpoint_begins_a_new_report(spark, three_days, tmp_path):
    """Over an old path, readers get the newest run and not a mixture."""
    keys = ["interval_start", "PAYTYPE_515"]
    complete, updates = str(tmp_path / "complete"), str(tmp_path / "updates")

    def run(folder, number):
        report = interval_min_max(stream(spark, folder))
        stream_complete(report, complete, str(tmp_path / f"c{number}"), keys,
                        trigger=AT_ONCE).awaitTermination()
        stream_updates(report, updates, str(tmp_path / f"u{number}"), keys=keys, compact_every=2,
                       trigger=AT_ONCE).awaitTermination()

    run(three_days, 1)
    other = tmp_path / "other"
    other.mkdir()
    put_file(other, "later.csv", record_lines(24 * 9, 5), age=1)
    run(other, 2)
    expected = bag(interval_min_max(batch(spark, other)))
    assert bag(read_complete(spark, complete)) == expected
    columns = ["PAYTYPE_515", "min_revenue", "max_revenue", "interval_start"]
    assert bag(read_updates(spark, updates, keys).select(columns)) == expected


def test_joined_updates_replace_their_folders(spark, three_days, tmp_path):
    keys = ["interval_start", "PAYTYPE_515"]
    path = tmp_path / "updates"
    report = interval_min_max(stream(spark, three_days))
    stream_updates(report, str(path), str(tmp_path / "c"), keys=keys, compact_every=2,
                   trigger=AT_ONCE).awaitTermination()
    (run,) = path.iterdir()
    assert len(list((run / "joined").iterdir())) == 1
    assert len(list((run / "changes").iterdir())) <= 1
    columns = ["PAYTYPE_515", "min_revenue", "max_revenue", "interval_start"]
    got = read_updates(spark, str(path), keys).select(columns)
    assert bag(got) == bag(interval_min_max(batch(spark, three_days)))


def test_progress_beyond_what_spark_remembers(spark, tmp_path):
    source, kept = str(tmp_path / "in"), str(tmp_path / "progress")
    spark.range(40 * 7).repartition(40).write.parquet(source)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "20")
    listener = log_progress(spark, kept)
    try:
        files = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
        query = stream_appended(files, str(tmp_path / "o"), str(tmp_path / "c"), trigger=AT_ONCE)
        query.awaitTermination()
        assert listener.wait_for(query)
        assert len(query.recentProgress) <= 20
    finally:
        spark.streams.removeListener(listener)
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    progress = progress_rows(spark, kept, query)
    assert progress.agg(F.sum("input_rows")).first()[0] == 40 * 7
    assert progress.filter("input_rows > 0").select("batch_id").distinct().count() == 40


def test_amounts_in_a_stream_keep_their_type(spark, three_days):
    assert dict(interval_revenue(stream(spark, three_days)).dtypes)["revenue"] == "decimal(16,3)"
    total = batch(spark, three_days).agg(F.sum("revenue_toman")).first()[0]
    assert isinstance(total, Decimal)
