"""Exact duplicates against grouping in plain Python."""

from __future__ import annotations

from collections import defaultdict

import pytest
from brute import hashed
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import bag, plan
from meterline.llm import exact_dedup
from meterline.llm.columns import LOWER, UPPER

TABLE = str.maketrans(UPPER, LOWER)
TEXTS = ["a", "A", None, "", "É", "é", "a b", "A b", "x" * 50_000, "X" * 50_000, "x" * 49_999 + "y", "a"]


def expected(rows, keep):
    groups = defaultdict(list)
    for key, text in rows:
        groups[(text or "").translate(TABLE)].append(key)
    best = max if keep == "largest" else min
    out, seen = [], set()
    for key, text in sorted(rows, key=repr):
        plain = (text or "").translate(TABLE)
        ids = [k for k in groups[plain] if k is not None]
        first = best(ids) if ids else None
        kept = key == first and plain not in seen
        if kept:
            seen.add(plain)
        out.append((key, first, len(groups[plain]), kept, hashed(plain)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("hot", [False, True])
def test_nulls_ties_repeats_and_long_texts(docs_of, monkeypatch, keep, hot):
    if hot:
        monkeypatch.setattr(exact_dedup, "LEAST_HOT_ROWS", 1)
        monkeypatch.setattr(exact_dedup, "PARTS_OF_PARTITION", 1000)
    rows = list(enumerate(TEXTS)) + [(3, ""), (3, ""), (0, "a"), (None, "a"), (None, None), (None, "z")]
    found = exact_dedup.exact_duplicates(docs_of(rows), keep=keep)
    assert found.columns[:4] == ["doc_id", "text", "_text", "key"]
    got = bag(found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))
    assert got == expected(rows, keep)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="aAbé ", max_size=3), min_size=1, max_size=60))
def test_any_rows_through_salted_groups(spark, texts):
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = exact_dedup.LEAST_HOT_ROWS, exact_dedup.PARTS_OF_PARTITION
    exact_dedup.LEAST_HOT_ROWS, exact_dedup.PARTS_OF_PARTITION = 2, 1000
    try:
        got = bag(exact_dedup.exact_duplicates(docs).drop("text"))
    finally:
        exact_dedup.LEAST_HOT_ROWS, exact_dedup.PARTS_OF_PARTITION = before
    assert got == expected(rows, "smallest")


def test_empty_table(docs_of):
    assert exact_dedup.exact_duplicates(docs_of([])).count() == 0
    assert exact_dedup.without_duplicates(docs_of([])).columns == ["doc_id", "text", "_text", "key"]


def test_a_column_named_as_a_result_is_replaced(spark):
    docs = spark.createDataFrame([(1, "a", "old"), (2, "A", "old")], "doc_id long, text string, kept string")
    found = exact_dedup.exact_duplicates(docs)
    assert bag(found.select("doc_id", "kept")) == [(1, True), (2, False)]


def test_rejects_an_unknown_choice(docs_of):
    with pytest.raises(ValueError):
        exact_dedup.exact_duplicates(docs_of([]), keep="first")


def test_texts_are_shuffled_once_and_without_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    shown = plan(exact_dedup.exact_duplicates(docs))
    assert shown.count("rangepartitioning") == 1
    assert shown.count("hashpartitioning(_start") == 0
    assert "Python" not in shown and "Arrow" not in shown


def test_a_hot_text_is_cut_into_salts(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LEAST_HOT_ROWS", 10)
    monkeypatch.setattr(exact_dedup, "PARTS_OF_PARTITION", 20)
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'Same', concat('t', id)) AS text")
    hashes = docs.selectExpr("xxhash64(lower(text)) AS _hash")
    salts = exact_dedup.hot_texts(hashes, 3000, 8).collect()
    assert len(salts) == 1 and salts[0]._salts == -(-1000 // 18)
    found = exact_dedup.exact_duplicates(docs)
    kept = found.filter("kept").count()
    assert kept == 2001
    assert found.filter("text = 'Same'").select("keep_id", "group_size").distinct().collect() == [(0, 1000)]
