"""Personal data: patterns against plain regular expressions, the tagger by its gradients,
held-out spans and overlapping windows."""

from __future__ import annotations

import numpy as np
import pytest
from brute import personal
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import bag
from meterline.llm import char_tagger, pii

PARTS = ["a", "B", "9", "1", "2", "@", ".", "-", "+", " ", "(", ")", "%", "_", "é", "\n", "255", "256", "x.y", "555", "4111111111111111", "٣"]


def named(spans):
    return [(pii.KINDS[kind], start, end) for start, kind, end in spans]


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def tagger(table):
    return pii.fit(table)


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=30))
def test_base_spans_of_any_text(parts):
    text = "".join(parts)
    assert named(pii.base_spans(text)) == personal(text)


def test_long_runs_take_no_squares_of_time():
    for text in ("1" * 300_000, "1." * 150_000, "a" * 300_000 + "@", "a@" * 150_000, "+1" + "(" * 300_000, "+1-" * 100_000):
        pii.base_spans(text)


def test_base_spans_of_the_documents(table, documents, tagger):
    got = {r.doc_id: r.personal for r in pii.find(table, tagger).collect()}
    for d in documents:
        base = [(s.kind, s.start, s.end) for s in got[d["doc_id"]] if s.base]
        assert base == personal(d["text"])
        assert sorted(got[d["doc_id"]], key=lambda s: (s.start, s.order)) == got[d["doc_id"]]
    # Documents without any digit or at-sign are left alone, and hardly anything is added.
    assert sum(not s.base for spans in got.values() for s in spans) <= 5


def test_long_obfuscated_addresses_are_added():
    address = "first.middle.last" * 4 + " (at) " + "mail.department." * 4 + "example.org"
    text = f"write to {address}, soon"
    tags = np.zeros(len(text), np.int8)
    tags[9 : 9 + len(address)] = 1
    assert pii.added_spans(text, tags, []) == [(9, 0, 9 + len(address))]


def test_the_sample_holds_distinct_texts(spark, monkeypatch):
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    texts = spark.range(3000).select(F.concat(F.lit("write to a@b.org "), "id").alias("text"))
    hot = texts.orderBy(place).limit(1).crossJoin(spark.range(3000)).select("text")
    seen = []
    monkeypatch.setattr(pii, "examples", lambda chosen, rng: (seen.append(chosen), (np.array([]), np.array([])))[1])
    pii.fit(hot.unionByName(texts), sample_rows=300)
    pii.fit(texts.repartition(3).unionByName(hot), sample_rows=300)
    assert seen[0] == seen[1] and 240 <= len(seen[0]) <= 360


def test_gradients():
    rng = np.random.default_rng(0)
    tagger = char_tagger.Tagger.fresh(5, 3, rng)
    tagger.weights = {name: value.astype(np.float64) for name, value in tagger.weights.items()}
    windows, tags = rng.integers(0, 5, (4, 7)), rng.integers(0, 3, (4, 7))
    _, grads = tagger.gradients(windows, tags)
    for name, value in tagger.weights.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in value.shape)
            was, step = value[at], 1e-3
            value[at] = was + step
            more, _ = tagger.gradients(windows, tags)
            value[at] = was - step
            less, _ = tagger.gradients(windows, tags)
            value[at] = was
            assert (more - less) / (2 * step) == pytest.approx(grads[name][at], abs=1e-4)


def test_decoding_finds_the_best_path():
    rng = np.random.default_rng(2)
    tagger = char_tagger.Tagger.fresh(4, 3, rng)
    tagger.weights["follow"] = rng.normal(0, 1, (3, 3)).astype(np.float32)
    windows = rng.integers(0, 4, (6, 5))
    scores, follow = tagger.scores(np.ascontiguousarray(windows.T)), tagger.weights["follow"]
    for i, found in enumerate(tagger.decode(windows)):

        def value(path, i=i):
            total = sum(scores[t, i, tag] for t, tag in enumerate(path)) + tagger.weights["first"][path[0]]
            return total + sum(follow[a, b] for a, b in zip(path, path[1:]))

        best = max(np.ndindex(3, 3, 3, 3, 3), key=value)
        assert value(found.tolist()) == pytest.approx(value(best), abs=1e-4)


def test_tags_of_held_out_spans(documents, tagger):
    """The tagger alone finds nearly all base spans of rows it was not trained on, too."""
    texts = [d["text"] for d in documents]
    rng = np.random.default_rng(4)
    half = char_tagger.train(*pii.examples(texts[::2], rng), pii.SYMBOLS, 5, 1)
    found = total = 0
    for text, tags in zip(texts[1::2], pii.tagged([pii.symbols(t) for t in texts[1::2]], half), strict=True):
        for start, kind, end in pii.base_spans(text):
            total += 1
            found += np.mean(tags[start:end] == kind + 1) > 0.8
    assert total > 20 and found >= 0.9 * total


def test_spans_that_patterns_miss_are_added(documents, tagger):
    """Labelled data of documents, rewritten as people also write it, in their own context."""
    rng, found, total = np.random.default_rng(8), 0, 0
    for d in documents:
        for start, kind, end in pii.base_spans(d["text"]):
            written = pii.variants(kind, d["text"][start:end], rng)
            text = d["text"][max(0, start - 200) : start] + written + d["text"][end : end + 200]
            base = pii.base_spans(text)
            at = min(start, 200)
            if any(a < at + len(written) and at < b for a, _, b in base) or not pii.holds(kind, written):
                continue
            (tags,) = pii.tagged([pii.symbols(text)], tagger)
            total += 1
            found += any(a < at + len(written) and at < b for a, _, b in pii.added_spans(text, tags, base))
    assert total > 20 and found >= 0.7 * total


@pytest.mark.parametrize("length", [1, 64, 95, 96, 97, 128, 129, 191, 192, 193, 320, 1000])
def test_windows_cover_and_agree(length):
    marks = np.full(length, pii.DIGIT, np.uint8)
    windows = pii.windows_of(marks)
    assert windows.shape == (max(1, -(-(length - 64) // 64)), pii.WINDOW)
    # Each window says its own number, so the owner of each place can be read.
    tags = np.repeat(np.arange(len(windows), dtype=np.int8)[:, None], pii.WINDOW, axis=1)
    owners = pii.reconciled(tags, length)
    assert len(owners) == length
    for place, owner in enumerate(owners):
        distances = [abs(place - (64 * i + 63.5)) for i in range(len(windows))]
        assert distances[owner] == min(distances)


def test_a_long_text_is_tagged_as_its_parts(tagger):
    span = "+1 (578) 555-6437"
    text = ("word " * 37 + span + " ") * 400
    base = pii.base_spans(text)
    assert len(base) == 400
    (tags,) = pii.tagged([pii.symbols(text)], tagger)
    hit = [np.mean(tags[a:b] == 4) > 0.8 for a, _, b in base]
    assert np.mean(hit) > 0.9


def test_windows_far_from_telling_signs_have_no_tags(tagger):
    (tags,) = pii.tagged([pii.symbols("no such thing " * 50)], tagger)
    assert not tags.any()
    telling = [i for i, sign in enumerate(pii.SIGNS, 6) if sign in "@(["]
    assert np.flatnonzero(pii.TELLING).tolist() == sorted([pii.DIGIT, *telling])


def test_words_near_signs():
    def near(text):
        return "".join(c if n else "_" for c, n in zip(text, pii.near_signs(pii.symbols(text)), strict=True))

    assert near("far away name (at) host . org and more") == "_________name_(at)_host_______________"
    assert near("x 10 . 20 . 30 y z\n") == "x_10_._20_._30_y___"
    assert near("a b  c") == "______" and near(" 7 ") == "_7_"


@pytest.mark.parametrize("lead", [0, 40, 63, 64, 65, 100, 127, 200])
def test_skipped_windows_change_no_span(tagger, monkeypatch, lead):
    """The head of an address may lie in a window without any sign."""
    text = "plain words here " * 20
    text = text[:lead] + " " + "long.local.part." * 9 + "x (at) host.example.org or (571) 555-6437 " + text
    found = {}
    for skip in (True, False):
        if not skip:
            monkeypatch.setattr(pii, "near_signs", lambda marks: np.ones(len(marks), bool))
        (tags,) = pii.tagged([pii.symbols(text)], tagger)
        found[skip] = pii.added_spans(text, tags, pii.base_spans(text))
    assert found[True] == found[False]


@pytest.mark.parametrize("part", ["0" * 5000, "0" * 4999 + "7", "0255", "256", "9" * 5000, "00", "999"])
def test_parts_of_any_length(part):
    text = f"at 1.2.3.{part} or {part}.2.3.4"
    assert named(pii.base_spans(text)) == personal(text)


def test_nulls_empty_texts_and_repeats(docs_of, tagger):
    mail = "é write to a.b@c.example now"
    docs = docs_of([(1, None), (2, ""), (3, mail), (3, mail), (None, "1.2.3.4")])
    found = pii.find(docs, tagger)
    assert found.columns == ["doc_id", "text", "_text", "key", "personal"]
    got = bag(found.selectExpr("doc_id", "transform(personal, s -> concat_ws(':', s.kind, s.start, s.end)) AS s"))
    assert got == sorted([(1, []), (2, []), (3, ["email:11:24"]), (3, ["email:11:24"]), (None, ["ip:0:7"])], key=repr)
    assert pii.find(docs.limit(0), tagger).count() == 0


def test_without_labelled_spans(docs_of):
    docs = docs_of([(1, "nothing"), (2, None)])
    assert pii.fit(docs) is None and pii.fit(docs.limit(0)) is None
    assert bag(pii.find(docs, None).selectExpr("size(personal)")) == [(0,), (0,)]
