"""Small units of many batches joined into few files, for readers that go on meanwhile."""

from __future__ import annotations

import json
from pathlib import Path

import pytest

from meterline.sinks import joined
from meterline.sinks.joined import join_batches, read_batches
from meterline.streaming import control

ROW = "n int"


def add(path, numbers, run="r"):
    for n in numbers:
        folder = path / f"{run}-{n:010d}"
        folder.mkdir(parents=True)
        (folder / "part.json").write_text(json.dumps({"n": n}) + "\n")


def values(spark, path) -> list[int]:
    return sorted(r.n for r in read_batches(spark, str(path), ROW, "json").collect())


def files(path) -> int:
    return sum(1 for p in Path(path).rglob("*") if p.is_file() and not p.name.startswith((".", "_SUCCESS")))


def join(spark, path, **options):
    return join_batches(spark, str(path), ROW, "json", **({"least": 10, "min_age": 0} | options))


def test_many_units_leave_few_files_and_all_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(joined, "MOST_PARTS", 2)
    path = tmp_path / "out"
    for at in range(0, 750, 150):
        add(path, range(at, at + 150))
        assert join(spark, path) in (149, 150)
        assert values(spark, path) == list(range(at + 150))
    assert join(spark, path) == 0  # only the newest is left, but what was joined goes now
    assert files(path) < 30 and values(spark, path) == list(range(750))


def test_units_stay_for_readers_that_began_before(spark, tmp_path, monkeypatch):
    path = tmp_path / "out"
    add(path, range(30))
    before = read_batches(spark, str(path), ROW, "json")
    assert join(spark, path, min_age=60) == 29
    assert len(list(path.glob("r-*"))) == 30
    assert before.count() == 30 and values(spark, path) == list(range(30))
    now = joined.time.time
    monkeypatch.setattr(joined.time, "time", lambda: now() + 61)
    join(spark, path, min_age=60)
    assert len(list(path.glob("r-*"))) == 1 and values(spark, path) == list(range(30))


def test_the_newest_unit_of_each_run_may_be_written_again(spark, tmp_path):
    path = tmp_path / "out"
    add(path, range(20), "a")
    add(path, range(20, 40), "b")
    assert join(spark, path) == 38
    (path / "b-0000000039" / "part.json").write_text('{"n": 1039}\n')
    assert values(spark, path) == [*range(39), 1039]


def test_a_reader_that_lists_before_units_are_joined_and_removed(spark, tmp_path, monkeypatch):
    path, manifest, once = tmp_path / "out", joined._manifest, []
    add(path, range(30))

    def late(*arguments):
        if not once:  # after the reader has listed, before it reads the manifest
            once.append(1)
            join(spark, path)
            join(spark, path)
        return manifest(*arguments)

    monkeypatch.setattr(joined, "_manifest", late)
    assert values(spark, path) == list(range(30))


def test_two_joins_at_once(spark, tmp_path, monkeypatch):
    path, write, once = tmp_path / "out", joined.write_version, []
    add(path, range(30))

    def overtaken(*arguments):
        if not once:
            once.append(1)
            assert join(spark, path) == 29
        return write(*arguments)

    monkeypatch.setattr(joined, "write_version", overtaken)
    assert join(spark, path) == 0
    join(spark, path)
    assert values(spark, path) == list(range(30))
    assert len(list((path / "_joined").glob("part-*"))) == 1


@pytest.mark.parametrize("least", [1, 50])
def test_progress_files(spark, tmp_path, least):
    for n in range(120):
        day = tmp_path / f"2024-01-{1 + n // 50:02d}"
        day.mkdir(exist_ok=True)
        row = {"query": "q", "run": "r", "batch_id": n, "input_rows": 1, "started": "2024"}
        (day / f"r-{n:012d}-2024-01-01T000000.000Z.json").write_text(json.dumps(row) + "\n")
    assert control.join_progress(spark, str(tmp_path), least, min_age=0) == 120
    assert control.join_progress(spark, str(tmp_path), least, min_age=0) == 0
    assert not list(tmp_path.rglob("r-*"))
    rows = control.progress_rows(spark, str(tmp_path)).collect()
    assert sorted(r.batch_id for r in rows) == list(range(120))


def test_nothing_there(spark, tmp_path):
    assert join(spark, tmp_path / "none") == 0 and values(spark, tmp_path / "none") == []
