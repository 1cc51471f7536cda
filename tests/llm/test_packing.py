"""Packed sequences: every token once, no gaps, and few sequences."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from meterline.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_sequences(found, capacity):
    places = defaultdict(list)
    for row in found:
        assert 0 < row.length <= capacity
        places[row.sequence_id].append((row.offset, row.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def pieces_of(text, library, capacity=2048):
    ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
    out = []
    for piece, start in enumerate(range(0, len(ids), capacity)):
        some = ids[start : start + capacity]
        out.append((piece, start, len(some), zlib.crc32(np.array(some, dtype="<u4").tobytes())))
    return out


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_documents(spark, documents, library):
    found = packing.pack(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), PATH).collect()
    wanted = {(d["doc_id"], *p) for d in documents for p in pieces_of(d["text"], library)}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found} == wanted
    assert len(found) == len(wanted)
    total = sum(r.length for r in found)
    assert check_sequences(found, 2048) <= 1.02 * total / 2048 + 1


def test_edges(docs_of, library):
    exact = "a " * 2047  # with its end id just full
    docs = [(1, None), (2, ""), (3, exact), (4, exact + "a"), (4, exact + "a"), (None, "a"), (5, "é " * 9000)]
    found = packing.pack(docs_of(docs), PATH)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found.collect()], key=repr)
    assert got == sorted([(k, *p) for k, text in docs for p in pieces_of(text, library)], key=repr)
    check_sequences(found.collect(), 2048)
    assert [r.length for r in found.filter("doc_id = 3").collect()] == [2048]
    assert packing.pack(docs_of([]), PATH).count() == 0


@pytest.mark.parametrize("tasks", [1, 7])
def test_many_tasks_share_no_sequence(spark, tasks):
    docs = spark.range(2000).selectExpr("id AS doc_id", "repeat('word ', int(pmod(id * 7919, 900))) AS text")
    found = packing.pack(docs, PATH, pieces_per_task=-(-2000 // tasks)).collect()
    assert len(found) == 2000
    n = check_sequences(found, 2048)
    assert n <= sum(r.length for r in found) / 2048 * 1.01 + tasks


def test_best_fit_takes_the_least_room():
    fit = packing.BestFit(10, 10)
    assert [fit.place(n) for n in (7, 5, 3, 4, 1)] == [(0, 0), (1, 0), (0, 7), (1, 5), (1, 9)]


def test_the_fullest_closes_first():
    fit = packing.BestFit(10, 2)
    assert [fit.place(n)[0] for n in (6, 7, 8)] == [0, 1, 2]
    assert fit.open == 2
    assert fit.place(2)[0] == 1  # sequence 2, with room for it, was the fullest


@pytest.mark.parametrize("most_open", [1, 3, 50, 10_000])
def test_against_a_plain_best_fit(most_open):
    rng = random.Random(most_open)
    fit, rooms, opened = packing.BestFit(100, most_open), {}, 0
    for _ in range(3000):
        n = rng.randrange(1, 101)
        sequence, at = fit.place(n)
        fitting = [room for room in rooms.values() if room >= n]
        if fitting:
            assert rooms[sequence] == min(fitting) and at == 100 - rooms[sequence]
        else:
            assert (sequence, at) == (opened, 0)
            opened += 1
        rooms[sequence] = 100 - at - n
        if not rooms[sequence]:
            del rooms[sequence]
        if len(rooms) > most_open:
            least = min(rooms.values())
            closed = {s for s, room in rooms.items() if room == least}
            still = {s for room in fit.by_room for s in room}
            (gone,) = closed - still
            del rooms[gone]
        assert fit.open == len(rooms) <= most_open


def test_wrong_lengths_are_refused():
    with pytest.raises(ValueError):
        packing.BestFit(10).place(11)
