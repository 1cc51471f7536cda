from __future__ import annotations

import csv
import random
from pathlib import Path

import pytest
from helpers import bag, plan, rows
from hypothesis import HealthCheck, Phase, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterline import (
    empty_dimension,
    find,
    last_write,
    load_counters,
    load_dimension,
    load_into,
    lookup,
    read_dimension,
    read_dimension_files,
    upsert,
    write_version,
)
from meterline.operators.joins import fits_broadcast, hot_keys, salted_join, sized_join
from meterline.plans.dimension import dimension_from
from meterline.schemas import DIMENSION_ALIASES
from meterline.sinks.versions import VersionConflict, merge_version, read_latest, write_changes


@pytest.fixture
def city_files(tmp_path):
    folder = tmp_path / "cities"
    folder.mkdir()
    (folder / "a.csv").write_text("city,countyCode\nBerlin,DE\n Paris ,FR\n,IT\nRome,\n")
    (folder / "b.csv").write_text("CountryCode,Name,x\nGB,London,1\nUS,Berlin,2\n")
    (folder / "c.csv").write_text('city,City,country_code\n,Oslo,NO\n"   ",,SE\n')
    (folder / "notes.txt").write_text("city,countyCode\nNowhere,XX\n")
    return str(folder)


def test_header_layouts(spark, city_files):
    loaded = load_dimension(spark, city_files)
    assert loaded.counters == {"total": 8, "succeeded": 6, "failed": 2}
    assert bag(loaded.accepted.select("name", "country_code")) == sorted(
        [("Berlin", "DE"), ("Paris", "FR"), ("London", "GB"), ("Berlin", "US"), ("Oslo", "NO"),
         ("", "SE")],
        key=repr,
    )
    assert bag(loaded.rejected.select("name", "country_code")) == sorted(
        [(None, "IT"), ("Rome", None)], key=repr
    )
    assert rows(load_counters(read_dimension_files(spark, city_files))) == [(8, 6, 2)]
    later_file_wins = dimension_from(loaded.accepted).filter("name = 'Berlin'")
    assert rows(later_file_wins) == [("Berlin", "US")]


def test_very_many_files_need_no_broadcast(spark, city_files, monkeypatch):
    expected = bag(read_dimension_files(spark, city_files).drop("row_id"))
    monkeypatch.setattr("meterline.operators.joins.fits_broadcast", lambda *a, **k: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unbroadcast = read_dimension_files(spark, city_files)
        assert "SortMergeJoin" in plan(unbroadcast)
        assert bag(unbroadcast.drop("row_id")) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_blank_names_can_be_rejected(spark, city_files):
    assert rows(load_counters(read_dimension_files(spark, city_files, reject_blank=True))) == [(8, 5, 3)]


def test_awkward_files(spark, tmp_path):
    quoted = "\ufeffname,country_code\r\n\"Quote \"\"A\"\", B\",Q\r\n"
    (tmp_path / "bom.csv").write_text(quoted, encoding="utf-8", newline="")
    (tmp_path / "case.csv").write_text("CITY,country_code\nHidden,XX\n")
    (tmp_path / "twice.csv").write_text("name,country_code,name\nfirst,T,last\n")
    (tmp_path / "short.csv").write_text("country_code,name\nS\nL,Long,more,cells\n")
    (tmp_path / "only_header.csv").write_text("city,countyCode\n")
    (tmp_path / "quoted.csv").write_text('"x, y","name","CountryCode"\n1,Quoted,QH\n')
    (tmp_path / "nbsp.csv").write_text("name,country_code\n Tab\t, N \n")
    loaded = load_dimension(spark, str(tmp_path))
    assert bag(loaded.accepted.select("name", "country_code")) == sorted(
        [('Quote "A", B', "Q"), ("last", "T"), ("Long", "L"), ("Quoted", "QH"), ("Tab", "N")],
        key=repr,
    )
    assert loaded.counters == {"total": 7, "succeeded": 5, "failed": 2}


def test_lines_inside_quotes(spark, tmp_path):
    (tmp_path / "m.csv").write_text('name,country_code\n"New\nYork",US\n')
    loaded = load_dimension(spark, str(tmp_path))
    assert rows(loaded.accepted.select("name", "country_code")) == [("New\nYork", "US")]


def test_last_row_of_a_file_wins_across_splits(spark, tmp_path):
    lines = [f"key{i % 7},{i:08d}" for i in range(20000)]
    (tmp_path / "big.csv").write_text("city,country_code\n" + "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows_read = read_dimension_files(spark, str(tmp_path), multi_line=False)
        assert rows_read.rdd.getNumPartitions() > 5
        assert rows(load_counters(rows_read)) == [(20000, 20000, 0)]
        newest = dict(rows(dimension_from(rows_read.filter("accepted"))))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert newest == {f"key{i % 7}": f"{i:08d}" for i in range(19993, 20000)}


def test_no_files(spark, tmp_path):
    with pytest.raises(ValueError, match="no file"):
        read_dimension_files(spark, str(tmp_path))


def test_load_into_versions(spark, city_files, tmp_path):
    stored = str(tmp_path / "stored")
    assert read_dimension(spark, stored).count() == 0
    load_into(spark, city_files, stored)
    assert dict(rows(read_dimension(spark, stored))) == {
        "Berlin": "US", "Paris": "FR", "London": "GB", "Oslo": "NO", "": "SE"
    }
    more = tmp_path / "more"
    more.mkdir()
    (more / "d.csv").write_text("name,country_code\nAustin,AUS\nOslo,NOR\n")
    load_into(spark, str(more), stored)
    merged = dict(rows(read_dimension(spark, stored)))
    assert merged["Austin"] == "AUS" and merged["Oslo"] == "NOR" and len(merged) == 6


def version_names(path) -> list[str]:
    return sorted(p.name for p in Path(path).iterdir() if p.name.startswith("version="))


def test_unfinished_and_old_versions(spark, tmp_path):
    path = str(tmp_path / "table")
    assert read_latest(spark, path) is None
    for value in range(4):
        number = write_version(spark.range(value, value + 1), path, keep=2, min_age=0)
    assert number == 4 and rows(read_latest(spark, path)) == [(3,)]
    assert version_names(path) == ["version=0000000003", "version=0000000004"]
    (tmp_path / "table" / "version=0000000009").mkdir()
    assert rows(read_latest(spark, path)) == [(3,)]
    assert write_version(spark.range(1), path) == 10


def test_two_writers_of_one_base(spark, tmp_path):
    """The slower one fails, and merges again on what the faster one has written."""
    path = str(tmp_path / "table")
    schema = "name string, country_code string"
    write_version(spark.createDataFrame([("a", "0")], schema), path)
    mine = upsert_row(spark, read_latest(spark, path), "b")
    assert write_version(upsert_row(spark, read_latest(spark, path), "c"), path, base=1) == 2
    with pytest.raises(VersionConflict):
        write_version(mine, path, base=1)
    seen = []

    def merge(base):
        if not seen:  # somebody is faster once more
            write_version(upsert_row(spark, base, "d"), path, base=2)
        seen.append(bag(base))
        return upsert_row(spark, base, "b")

    assert merge_version(spark, path, merge) == 4
    assert len(seen) == 2
    assert sorted(r.name for r in read_latest(spark, path).collect()) == ["a", "b", "c", "d"]
    assert not [p for p in (tmp_path / "table").iterdir() if p.name.startswith("_")]


def upsert_row(spark, base, name):
    return base.unionByName(spark.createDataFrame([(name, "0")], base.schema))


def test_changes_are_laid_over_versions(spark, tmp_path):
    path, schema = str(tmp_path / "table"), "name string, country_code string"
    expected: dict = {}
    for number in range(9):
        changes = {f"k{number % 4}": str(number), f"n{number}": "new"}
        rows_ = spark.createDataFrame(list(changes.items()), schema)
        write_changes(rows_, path, "name", compact_every=3, keep=1, min_age=0)
        expected |= changes
        assert dict(rows(read_latest(spark, path))) == expected
    assert len(version_names(path)) <= 4
    # A whole version replaces all changes before it.
    write_version(spark.createDataFrame([("only", "1")], schema), path)
    assert rows(read_latest(spark, path)) == [("only", "1")]


def test_loading_into_a_catalog_table(spark, city_files, tmp_path):
    empty = empty_dimension(spark)
    empty.write.option("path", str(tmp_path / "t")).format("parquet").saveAsTable("loaded_cities")
    try:
        load_into(spark, city_files, table="loaded_cities")
        more = tmp_path / "more"
        more.mkdir()
        (more / "d.csv").write_text("name,country_code\nAustin,AUS\nOslo,NOR\n")
        load_into(spark, str(more), table="loaded_cities")
        merged = dict(rows(read_dimension(spark, table="loaded_cities")))
    finally:
        spark.sql("DROP TABLE loaded_cities")
    assert merged["Austin"] == "AUS" and merged["Oslo"] == "NOR" and len(merged) == 6


def test_reading_a_catalog_table(spark):
    cities = spark.createDataFrame([("A", "B")], "name string, country_code string")
    cities.createOrReplaceTempView("cities")
    assert rows(read_dimension(spark, table="cities")) == [("A", "B")]


@pytest.fixture
def writes(spark):
    rng = random.Random(5)
    data = [(("hot" if rng.random() < 0.4 else f"k{rng.randrange(60)}"), rng.randrange(50), i,
             f"v{i}") for i in range(3000)]
    return data, spark.createDataFrame(data, "name string, day int, seq long, code string")


def expected_last(data):
    newest = {}
    for name, day, seq, code in sorted(data, key=lambda r: (r[1], r[2])):
        newest[name] = code
    return newest


def test_last_write(spark, writes):
    data, df = writes
    result = last_write(df, "name", ["day", "seq"], ["code"])
    assert dict(rows(result)) == expected_last(data)
    assert "partial_max_by" in plan(result)


@pytest.mark.parametrize("max_rows", [100_000, 0])
def test_upsert_replaces_and_inserts(spark, writes, max_rows):
    data, df = writes
    base = {f"k{i}": "old" for i in range(40, 90)}
    table = spark.createDataFrame(list(base.items()), "name string, code string")
    merged = upsert(table, df, "name", ["day", "seq"], ["code"], max_rows=max_rows)
    assert merged.columns == ["name", "code"]
    assert dict(rows(merged)) == base | expected_last(data)
    assert ("BroadcastHashJoin LeftAnti" in plan(merged)) == (max_rows > 0)
    fresh = upsert(empty_dimension(spark, table.schema), df, "name", ["day", "seq"], ["code"])
    assert dict(rows(fresh)) == expected_last(data)


@pytest.fixture
def asked(spark):
    data = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 and i % 2 else f"c{i % 50}")
            for i in range(3000)]
    dimension = {"hot": "H", "c2": "", "c4": "D", "Hot": "other case"}
    return (
        data,
        spark.createDataFrame(data, "request_id long, city string").repartition(8),
        dimension,
        spark.createDataFrame(list(dimension.items()), "name string, country_code string"),
    )


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}, {"max_bytes": 10}])
def test_lookup(spark, asked, limits):
    data, requests, known, dimension = asked
    everything = lookup(requests, dimension, **limits)
    assert bag(everything.select("request_id", "city", "country_code", "found")) == sorted(
        [(i, c, known.get(c), c in known) for i, c in data], key=repr
    )
    found = lookup(requests, dimension, how="inner", **limits).select("request_id", "country_code")
    assert bag(found) == sorted([(i, known[c]) for i, c in data if c in known], key=repr)
    missing = lookup(requests, dimension, how="left_anti", **limits)
    assert bag(missing) == sorted([(i, c) for i, c in data if c not in known], key=repr)
    assert ("SortMergeJoin" in plan(everything)) == bool(limits)


def test_hot_keys_are_spread(spark, asked):
    data, requests, _, dimension = asked
    hot = hot_keys(requests, "city", 8)
    assert rows(hot) == [("hot", 8)]
    keyed = dimension.withColumnRenamed("name", "city")
    expected = bag(requests.join(keyed, "city", "left").select(*requests.columns, "country_code"))
    other = spark.createDataFrame([("hot", 16), ("c2", 2), ("c4", 2)], "city string, __tasks int")
    for arguments in ((hot, 1, 8), (None, 4, 4), (other, 1, 1)):
        spread = salted_join(requests, keyed, "city", "left", *arguments)
        assert bag(spread.select(*requests.columns, "country_code")) == expected


def test_equal_rows_are_spread_too(spark, monkeypatch):
    """100,000 rows that hold nothing but one key: no salt gets more than twice its share."""
    same = spark.range(0, 100_000, 1, 8).select(F.lit("hot").alias("city"))
    right = spark.createDataFrame([("hot", 1)], "city string, n int")
    hot = spark.createDataFrame([("hot", 16)], "city string, __tasks int")
    from meterline.operators import joins

    kept = []
    drop = type(same).drop
    monkeypatch.setattr(
        type(same), "drop", lambda df, *names: df if joins._SALT in names else drop(df, *names)
    )
    kept = rows(salted_join(same, right, "city", "left", hot).groupBy(joins._SALT).count())
    assert len(kept) == 16 and sum(n for _, n in kept) == 100_000
    assert max(n for _, n in kept) < 2 * 100_000 / 16


def test_map_columns_on_the_left(spark):
    left = spark.range(50).select(F.lit("a").alias("city"), F.create_map("id", "id").alias("m"))
    right = spark.createDataFrame([("a", 1)], "city string, n int")
    joined = sized_join(left, right, "city", "left", max_rows=0)
    assert joined.columns == ["city", "m", "n"] and joined.filter("n = 1").count() == 50


@pytest.mark.parametrize("unique", [None, "n"])
def test_salts_do_not_depend_on_the_order_of_rows(spark, unique):
    """A task that runs again may get its rows in another order; its salts stay the same."""
    from meterline.operators import joins

    left = spark.range(1000).select(F.lit("hot").alias("city"), F.col("id").alias("n"))
    hot = spark.createDataFrame([("hot", 16)], "city string, __tasks int")
    salted = joins.with_salt(left, "city", hot, 1, 1, unique)
    if unique:
        again = joins.with_salt(left.orderBy(F.desc("n")), "city", hot, 1, 1, unique)
        assert bag(salted.select("n", joins._SALT)) == bag(again.select("n", joins._SALT))
    else:  # read back from where they were written
        assert "Scan parquet" in plan(salted) and "rand(" not in plan(salted)
    sizes = [n for _, n in rows(salted.groupBy(joins._SALT).count())]
    assert len(sizes) == 16 and max(sizes) < 2 * 1000 / 16


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}])
def test_null_is_a_key_like_any_other(spark, limits):
    schema = "name string, country_code string"
    base = spark.createDataFrame([("a", "0"), (None, "old")], schema)
    for value in ("new", "newer"):
        updates = spark.createDataFrame([(None, value, 1), ("b", value, 1)], schema + ", at int")
        base = upsert(base, updates, "name", ["at"], ["country_code"], **limits)
    assert bag(base) == sorted([("a", "0"), (None, "newer"), ("b", "newer")], key=repr)


def test_hot_keys_are_bounded_and_skip_rare_keys(spark):
    even = spark.range(20000).select((F.col("id") % 5000).alias("k"))
    assert hot_keys(even, "k", 64) is None
    few = spark.range(20000).select((F.col("id") % 5).alias("k"))
    levels = dict(rows(hot_keys(few, "k", 64)))
    assert sorted(levels) == [0, 1, 2, 3, 4] and set(levels.values()) <= {16, 32}
    assert hot_keys(even.limit(0), "k", 64) is None
    assert hot_keys(spark.createDataFrame([(None,)] * 9, "k string"), "k", 4) is None


def test_a_rare_key_is_hot_on_very_many_partitions(spark):
    """A key of one row in 2,500 is eight times the fair share of one in 20,000 partitions."""
    wide = spark.range(2_000_000).select(
        F.when(F.col("id") % 2500 == 0, -1).otherwise(F.col("id")).alias("k")
    )
    found = dict(rows(hot_keys(wide, "k", 20_000)))
    assert found[-1] in (16, 32)
    assert len(found) <= 2 * 20_000


def test_dimension_copies_of_a_key_are_kept_when_salted(spark, asked):
    _, requests, _, dimension = asked
    doubled = dimension.unionByName(dimension).withColumnRenamed("name", "city")
    plain = requests.join(doubled, "city", "left")
    salted = sized_join(requests, doubled, "city", "left", max_rows=0)
    assert bag(salted.select(plain.columns)) == bag(plain)


def test_size_check_counts_rows_and_bytes(spark):
    small = spark.range(10).withColumn("t", F.lit("x" * 100)).withColumn("a", F.array("id"))
    assert fits_broadcast(small)
    assert not fits_broadcast(small, max_rows=9)
    assert not fits_broadcast(small, max_bytes=1000)
    assert fits_broadcast(small.limit(0), max_rows=0)


def test_find_is_exact_and_pushed_down(spark, tmp_path):
    path = str(tmp_path / "d")
    write_version(
        spark.createDataFrame([("Rome", "IT"), ("rome", "XX")], "name string, country_code string"),
        path,
    )
    one = find(read_dimension(spark, path), "name", "Rome")
    assert rows(one) == [("Rome", "IT")]
    assert "EqualTo(name,Rome)" in plan(one)


# Shrinking a failure would take minutes, as every example is a Spark job.
FEW = settings(
    deadline=None,
    suppress_health_check=list(HealthCheck),
    phases=[Phase.explicit, Phase.reuse, Phase.generate],
)
HEADERS = st.lists(
    st.sampled_from(["city", "City", "name", "Name", "countyCode", "country_code", "CountryCode",
                     "x", "y z", " city"]),
    min_size=1,
    max_size=6,
)


def files_of(alphabet: str):
    lines = st.lists(st.lists(st.text(alphabet, max_size=5), min_size=1, max_size=7), max_size=5)
    return st.lists(st.tuples(HEADERS, lines), min_size=1, max_size=4)


def as_a_csv_reader_would(folder, files) -> list[tuple]:
    """Write the files, and read them back row by row."""
    expected = []
    for number, (header, lines) in enumerate(files):
        path = folder / f"f{number}.csv"
        with path.open("w", newline="", encoding="utf-8") as out:
            writer = csv.writer(out, lineterminator="\n")
            writer.writerow(header)
            # A line without visible text is no row to Spark.
            writer.writerows(line for line in lines if ",".join(line).strip())
        with path.open(newline="", encoding="utf-8") as source:
            for row in csv.DictReader(source):
                picked = {
                    target: next((row[a] for a in spellings if row.get(a)), None)
                    for target, spellings in DIMENSION_ALIASES.items()
                }
                accepted = None not in picked.values()
                expected.append((*[v and v.strip() for v in picked.values()], accepted))
    return expected


def read_in_order(spark, folder, **reading) -> list[tuple]:
    read = read_dimension_files(spark, str(folder), **reading)
    ordered = read.orderBy("file_path", "block_start", "row_id")
    return rows(ordered.select("name", "country_code", "accepted"))


@settings(FEW, max_examples=12)
@given(files_of("ab ,\"\t\xa0é'\\;"))
@example([(["city"] * 6, [["", "", '"', "", "", ",a'"]])])
def test_any_files(spark, tmp_path_factory, files):
    folder = tmp_path_factory.mktemp("files")
    expected = as_a_csv_reader_would(folder, files)
    assert read_in_order(spark, folder, multi_line=False) == expected


@settings(FEW, max_examples=8)
@given(files_of("ab ,\"\n'\\;"))
def test_any_files_with_lines_inside_quotes(spark, tmp_path_factory, files):
    folder = tmp_path_factory.mktemp("files")
    expected = as_a_csv_reader_would(folder, files)
    assert read_in_order(spark, folder) == expected
