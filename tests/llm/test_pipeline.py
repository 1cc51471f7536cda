"""The pipeline against its stages in plain Python."""

from __future__ import annotations

import public_tokenizers
import pytest
from brute import secrets
from pyspark.sql import functions as F
from test_packing import check_sequences, pieces_of
from test_simhash import plain_components, plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from meterline.llm import language, secret_scan
from meterline.llm.columns import LOWER, UPPER
from meterline.session import cut_lineage

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def written(spark):
    """What each stage returns, written and read again."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    # Besides, near copies: long documents with one more word at the end.
    more = docs.filter("n_chars > 6000").withColumns(
        {"doc_id": F.expr("doc_id + 100000"), "text": F.expr("text || ' the'"), "n_chars": F.expr("n_chars + 4")}
    )
    docs = cut_lineage(docs.unionByName(more))
    out.append(docs)
    for _, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, FOLDER))
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_all_but_the_last_return_documents(written):
    for docs in written[1:-1]:
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert docs.count() == docs.select("doc_id").distinct().count()


def test_language_keeps_clean_documents(spark, written):
    model = language.fit(written[0].filter(language.fold("doc_id") != 0))
    before, kept = texts(written[0]), texts(written[1])
    assert len(kept) >= 0.99 * len(before)
    keys = sorted(before)
    averages, counts = language.means([language.code_points(before[k]) for k in keys], model.weights)
    best = model.probabilities(averages).max(axis=1)
    wanted = {k for k, n, b in zip(keys, counts, best, strict=True) if n and b >= model.limit}
    assert set(kept) == wanted


def test_exact_copies_go(written):
    table, last = str.maketrans(UPPER, LOWER), {}
    for key, text in sorted(texts(written[1]).items()):
        last[text.translate(table)] = key
    assert set(texts(written[2])) == set(last.values())


def test_near_copies_go(written):
    pairs = [(k, plain_fingerprint(t)) for k, t in texts(written[2]).items()]
    wanted = {k for (k, _), root in zip(pairs, plain_components(pairs), strict=True) if k == root}
    assert set(texts(written[3])) == wanted and len(wanted) < len(pairs)


def test_secrets_are_masked(spark, written):
    before, after = texts(written[3]), {r.doc_id: r for r in written[4].collect()}
    assert set(before) == set(after)
    changed = 0
    for key, text in before.items():
        row = after[key]
        assert not secrets(row.text)
        if not secrets(text) and row.text != text:
            changed += 1  # only the models can have found something
        if secrets(text):
            assert "[secret]" in row.text and row.n_chars == len(row.text)
    assert changed <= 2


def test_all_that_stays_is_packed(written):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    found = written[5].collect()
    wanted = {(k, *p) for k, t in texts(written[4]).items() for p in pieces_of(t, library)}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found} == wanted
    assert check_sequences(found, 2048) <= 1.02 * sum(r.length for r in found) / 2048 + 1


def test_run_is_its_stages(spark):
    def rows(df):
        return sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.collect())

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, FOLDER))
    assert rows(corpus_pipeline.run(spark, FOLDER)) == rows(docs)


def test_odd_documents(spark):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (None, None, None, None, None), (3, "password=abcdefgh the and", "en", "s", 25), (3, "password=abcdefgh the and", "en", "s", 25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for some in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            some = cut_lineage(stage(spark, some, FOLDER))
    assert some.count() == 0
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = cut_lineage(stage(spark, kept, FOLDER))
    assert [(r.doc_id, r.text) for r in kept.collect()] == [(3, "[secret] the and")]
