from __future__ import annotations

from test_records import BRIEF_ROWS

from meterline.__main__ import main


def test_reports(spark, tmp_path, capsys):
    (tmp_path / "brief.csv").write_text(BRIEF_ROWS)
    target = str(tmp_path / "out")
    arguments = ["reports", str(tmp_path / "brief.csv"), "--brief", "--fallback", "--single-file"]
    assert main([*arguments, "--mapping", str(tmp_path / "absent.csv"), "--target", target]) == 0
    assert "89.125" in capsys.readouterr().out
    (daily,) = (tmp_path / "out" / "daily_revenue").glob("*.csv")
    assert daily.read_text() == "date,total_revenue\n2023-11-05,89.125\n"


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    later = "12:00:00 2023/11/06,0,1000\n12:00:00 2023/11/08,0,1000\n"
    (tmp_path / "in" / "brief.csv").write_text(BRIEF_ROWS + later)
    (tmp_path / "map.csv").write_text("PayType,value\n0,Prepaid\n")
    target = tmp_path / "out"
    arguments = ["stream", str(tmp_path / "in"), "--brief", "--once", "--mapping"]
    arguments += [str(tmp_path / "map.csv"), "--target", str(target)]
    assert main([*arguments, "--checkpoints", str(tmp_path / "checkpoints")]) == 0
    lines = set()
    for file in (target / "daily_revenue").rglob("*.csv"):
        lines |= set(file.read_text().splitlines())
    assert lines == {"date,total_revenue", "2023-11-05,89.125"}
    reader = spark.read.option("header", True).option("recursiveFileLookup", True)
    named = reader.csv(str(target / "revenue_count_15min_by_paytype"))
    assert named.filter("value IS NULL").count() == 3 and named.count() == 8
    assert spark.streams.active == []


def test_dimension(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("city,countyCode\nBerlin,DE\nRome,\n")
    stored = str(tmp_path / "stored")
    assert main(["load", str(tmp_path / "in"), stored]) == 0
    assert "'total': 2, 'succeeded': 1, 'failed': 1" in capsys.readouterr().out
    assert main(["put", stored, " Austin ", "AUS"]) == 0
    assert main(["find", stored, "Austin"]) == 0
    assert main(["find", stored, "Rome"]) == 1
    assert capsys.readouterr().out == "AUS\nnot found\n"


def test_stats(spark, tmp_path, capsys):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.json").write_text(
        '{"city":"A","cache_status":"HIT"}\n{"city":"B","cache_status":"MISS"}\n'
    )
    assert main(["stats", str(tmp_path / "log")]) == 0
    assert "'total_requests': 2, 'cache_hits': 1" in capsys.readouterr().out
