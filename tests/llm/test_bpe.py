"""Encoding and decoding against the tokenizers library."""

from __future__ import annotations

import itertools
import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helpers import bag
from meterline.llm import bpe, columns

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = [
    "a", "b", "'s", "'LL", " ", "\n", "é", "é", "Σ", "ß", "İ", "<|startoftext|>", "<|endoftext|>",
    "<|", "1", "½", "²", "漢", "字", "😀", "​", "\x1c", "\x85", "\xa0", "　", "...", "!!", "Ab",
    "the", "ing", "ǅ", "ﬁ", "̀", "각", "ت", "\x00", "﻿", "_", "ª", "'", "Ᲊ", "\U00010d50",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def own():
    return bpe.encoder(PATH)


def ids(tool, text):
    return np.frombuffer(b"".join(tool.stream(text)), "<u4").tolist()


def test_every_document(documents, library, own):
    texts = [d["text"] for d in documents]
    for text, wanted in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids(own, text) == wanted.ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25))
def test_any_parts(library, own, parts):
    text = "".join(parts)
    assert ids(own, text) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_any_text(library, own, text):
    if any(0xD800 <= ord(c) < 0xE000 for c in text):
        return
    assert ids(own, text) == library.encode(text, add_special_tokens=False).ids


def test_texts_are_cut_at_blanks_only(library, own, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 5)
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice(PARTS) for _ in range(40))
        assert ids(own, text) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("alphabet", ["ab", "etaoinshr", "!?.", "abcdefghijklmnopqrstuvwxyz", "é漢a"])
def test_a_long_piece_in_a_small_buffer(library, own, alphabet):
    rng = random.Random(alphabet)
    for _ in range(15):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1500, 3000)))
        if "é漢" in alphabet:
            text = text.replace("é", "è")
        transducer, found, data, at, most = bpe.PieceTransducer(own.vocabulary, 1), [], text.encode(), 0, 0
        while at < len(data):
            step = rng.randrange(1, 400)
            found += transducer.feed(data[at : at + step])
            at += step
            most = max(most, len(transducer.held))
        found += transducer.finish()
        assert found == library.encode(text, add_special_tokens=False).ids
        assert most <= 4 * own.vocabulary.lookahead


def test_the_lookahead_is_sufficient(own):
    """Tokens that far from the end of a start of a piece never change."""
    rng, vocabulary = random.Random(1), own.vocabulary
    for _ in range(60):
        data = "".join(rng.choice("etaoinshrdlu") for _ in range(500)).encode()
        whole = vocabulary.merge([vocabulary.inner[b] for b in data])
        for cut in (200, 311, 420):
            part = vocabulary.merge([vocabulary.inner[b] for b in data[:cut]])
            end = 0
            for a, b in zip(part, whole, strict=False):
                end += vocabulary.symbols(a)
                if end > cut - vocabulary.lookahead:
                    break
                assert a == b


def vocabulary_of(merges):
    """A vocabulary of one-letter symbols without word ends."""
    own = bpe.Vocabulary.__new__(bpe.Vocabulary)
    own.suffix = "</w>"
    own.names = list(dict.fromkeys([*"abcehtz", *(left + right for left, right in merges)]))
    number = {name: i for i, name in enumerate(own.names)}
    own.ranks, own.made = {}, [number[left + right] for left, right in merges]
    for rank, (left, right) in enumerate(merges):
        own.ranks[number[left], number[right]] = rank
    own.lookahead = own.sufficient_lookahead()
    return own


def test_the_lookahead_follows_the_merged_token():
    assert vocabulary_of([("h", "e"), ("t", "he"), ("z", "the")]).lookahead == 3


def test_the_lookahead_against_all_short_texts():
    rng = random.Random(4)
    for _ in range(120):
        known, merges = [*"abc"], []
        while len(merges) < 7:
            pair = rng.choice(known), rng.choice(known)
            if pair not in merges and len("".join(pair)) <= 5:
                merges.append(pair)
                known += {"".join(pair)} - set(known)
        own = vocabulary_of(merges)
        for text in itertools.product(range(3), repeat=7):
            whole = own.merge(list(text))
            for cut in range(own.lookahead + 1, 7):
                end = 0
                for i, token in enumerate(own.merge(list(text[:cut]))):
                    end += own.symbols(token)
                    if end > cut - own.lookahead:
                        break
                    assert token == whole[i], (merges, text, cut)


def test_both_ways_of_merging(own):
    rng, vocabulary = random.Random(2), own.vocabulary
    for _ in range(300):
        data = "".join(rng.choice("aethinx") for _ in range(rng.randrange(2, 48))).encode()
        tokens = [*(vocabulary.inner[b] for b in data[:-1]), vocabulary.last[data[-1]]]
        assert vocabulary.merge(tokens) == vocabulary.merge_long(tokens)


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=40), st.lists(st.integers(0, 40), max_size=4))
def test_bytes_to_text_in_any_blocks(data, cuts):
    reader, out, at = bpe.Utf8Reader(), "", 0
    for cut in sorted({*(c for c in cuts if c < len(data)), len(data)}):
        out += reader.feed(data[at:cut])
        assert len(reader.held) <= 3
        at = cut
    assert out + reader.finish() == data.decode("utf-8", "replace")


def test_digests(spark, documents, library, docs_of):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in bpe.token_digests(docs, PATH).collect()}
    for d in documents[::7]:
        wanted = library.encode(d["text"], add_special_tokens=False).ids
        row = got[d["doc_id"]]
        assert row.n_tokens == len(wanted)
        assert row.ids_sha256 == sha256(np.array(wanted, dtype="<u4").tobytes()).hexdigest()
        decoded = library.decode(wanted, skip_special_tokens=False)
        assert row.decoded_sha256 == sha256(decoded.encode()).hexdigest()


def test_the_cache_is_bounded_and_frequent_pieces_stay(own, monkeypatch):
    tool, merges = bpe.Encoder(own.vocabulary), []
    monkeypatch.setattr(bpe, "CACHED_PIECES", 8)
    monkeypatch.setattr(own.vocabulary, "merge", lambda ids, f=own.vocabulary.merge: merges.append(1) or f(ids))
    wanted = tool.plain("the")
    for i in range(100):
        word = "".join(chr(97 + int(c)) for c in str(i))
        assert tool.plain(f"the x{word}") == wanted + bpe.Encoder(own.vocabulary).plain(f"x{word}")
        assert len(tool.cache) <= 8 and len(tool.older) <= 8
    merges.clear()
    assert tool.plain("the") == wanted and not merges


def test_a_worker_gives_its_cache_back_for_another_operator(own):
    columns.begin("packing")
    first = bpe.encoder(PATH)
    columns.begin("packing")
    assert bpe.encoder(PATH) is first
    columns.begin("language")
    assert not bpe._ENCODERS


def test_round_trip_through_words(docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "Some words, 12 é!"), (3, "Some words, 12 é!"), (None, "é漢 " * 70_000)])
    back = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert back.columns == ["doc_id", "text", "_text", "key", "ids", "decoded"]
    got = bag(back.select("doc_id", "decoded"))
    assert got == sorted(
        [(1, ""), (2, ""), (3, "some words , 1 2 é ! "), (3, "some words , 1 2 é ! "), (None, "é漢 " * 70_000)], key=repr
    )
    assert bpe.encode(docs.limit(0), PATH).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
