"""Importance resampling: checksums, features, weights and the draw, against plain Python."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from meterline.llm import importance

TEXTS = [None, "", " ", "one", "Two words", "x y z é É", "中文 中 文", "a-b_c.d\x00e", "w" * 900 + " tail end", "same same same same"]


def features(text: str | None) -> tuple[list[str], list[int]]:
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small)
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return words, [zlib.crc32(run.encode()) % 10_000 for run in runs]


def plain_draw(docs: list[tuple], target: list[str | None]) -> list[tuple]:
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    most, goal = s.total() + 10_000.0, t.total() + 10_000.0
    rows = []
    for i, text in docs:
        words, buckets = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1.0) * most / ((s[b] + 1.0) * goal))) for b in buckets)
        h = int(sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(words), len(buckets), weight, weight + noise))
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0]))
    drawn = able[: 5 * len(able) // 100]
    ranks = {id(r): place for place, r in enumerate(drawn, 1)}
    return [(*r, ranks.get(id(r))) for r in rows]


def of_texts(texts, slice_bytes, monkeypatch):
    """Counts of buckets, and the features of each text by their buckets."""
    monkeypatch.setattr(importance, "SLICE_BYTES", slice_bytes)
    batch = pa.record_batch({"t": pa.array(texts, pa.string())})
    found, held = [], []
    for _, words, whole in importance.segments([batch], "t"):
        runs = words.buckets(10_000)
        each = [
            [int(b) for run in runs for b in run[a:z] if b >= 0]
            for a, z in zip(words.edges[:-1], words.edges[1:], strict=True)
        ]
        held = [h + e for h, e in zip(held, each, strict=True)] if held else each
        if whole:
            found += held
            held = []
    return [sorted(f) for f in found]


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 255, 256, 257, 511, 512, 513, 769, 5000, 70_001])
def test_checksums_of_any_length(size):
    stream = np.random.default_rng(size).integers(0, 256, 80_000).astype(np.uint8)
    starts = np.array([0, 17, 80_000 - size])
    found = importance.checksums(stream, starts, np.full(3, size))
    assert found.tolist() == [zlib.crc32(stream[s : s + size].tobytes()) for s in starts]


def test_features_of_many_texts(documents, monkeypatch):
    texts = TEXTS + [d["text"] for d in documents[:200]]
    assert of_texts(texts, 1 << 20, monkeypatch) == [sorted(features(t)[1]) for t in texts]


@pytest.mark.parametrize("slice_bytes", [8, 64, 1000])
def test_a_long_text_in_parts_has_the_same_features(documents, monkeypatch, slice_bytes):
    texts = [*TEXTS, *(d["text"][:3000] for d in documents[:20]), "é" * 5000, "a b " * 900]
    assert of_texts(texts, slice_bytes, monkeypatch) == [sorted(features(t)[1]) for t in texts]


def test_resample_equals_plain_python(spark, documents):
    docs = [(d["doc_id"], d["text"][:2000]) for d in documents[:600]] + list(enumerate(TEXTS, 90_000))
    docs += [(None, "a null id " * 10), (None, None), (5, "again " * 30), (5, "again " * 30)]
    target = [None, "", *(d["text"][:500] for d in documents[40:60])]
    rows = [(i, text, 7, {"k": 1}, "x") for i, text in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, weight int, key map<string,int>, _id string")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    found = importance.resample(frame.repartition(5), goal)
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(plain_draw(docs, target), key=repr)


def test_ties_go_to_the_smaller_id_and_equal_rows_are_spread(spark):
    text = "tie " * 25
    frame = spark.range(4000).selectExpr("id % 2 as doc_id", f"'{text}' as text")
    found = importance.resample(frame, frame.limit(0))
    drawn = [r for r in found.collect() if r["rank"] is not None]
    assert sorted(r["rank"] for r in drawn) == list(range(1, 201))
    best = max(found.collect(), key=lambda r: (r.score, -r.doc_id))
    assert {r.doc_id for r in drawn} == {best.doc_id}


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resample(nothing, nothing).count() == 0
    one = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    (row,) = importance.resample(one, nothing).collect()
    assert (row.n_words, row.n_features, row["rank"]) == (3, 6, None)
