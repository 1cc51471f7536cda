"""Alignment of two vocabularies against plain loops over the bytes of each text."""

from __future__ import annotations

from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from meterline.llm import alignment
from meterline.llm.bpe import byte_characters

FILES = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
TEXTS = [
    None, "", " ", "  two  blanks ", "a▁b", "<|endoftext|> and <s> stay", "don't we'll", "naïve café ﬁ é",
    "中文没有空格，也行。再来一句！", "tab\tand\nline\n\n\nbreaks \x00 \x1f", "1234567890" * 3, "🙂👩‍👩‍👧 ok", "a" * 1500, " " * 1200,
    "<0x41>", "x y z", "ends with blank ",
]


@pytest.fixture(scope="module")
def plain():
    byte_level = Tokenizer.from_file(FILES[0])
    byte_level.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    to_byte = {c: b for b, c in enumerate(byte_characters())}

    def piece_bytes(i):
        name = pieces.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if pieces.is_byte(i) else name.replace("▁", " ").encode()

    def spans(ids, surface):
        at, out = 0, []
        for i in ids:
            out.append((i, at, at + len(surface(i))))
            at = out[-1][2]
        return out

    def tokens(text):
        if not text:
            return [], []
        a = byte_level.encode(" " + text, add_special_tokens=False).ids
        b = pieces.encode(text)
        bytes_of_a = {i: bytes(to_byte[c] for c in byte_level.id_to_token(i)) for i in set(a)}
        joined = b"".join(bytes_of_a[i] for i in a), b"".join(map(piece_bytes, b))
        if set(joined) != {(" " + text).encode()}:
            return [], []
        return spans(a, bytes_of_a.get), spans(b, piece_bytes)

    return tokens


def plain_rows(texts, tokens):
    aligned, counts = [], Counter()
    for text in texts:
        a, b = tokens(text)
        links, j = [], 0
        for i, start, end in a:
            while j and b[j - 1][2] > start:
                j -= 1
            while j < len(b) and b[j][1] < end:
                if b[j][2] > start:
                    links.append((i, b[j][0]))
                j += 1
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, begin = [], 0
        for end in ends:
            sides = [",".join(str(i) for i, s, e in side if begin <= s and e <= end) for side in (a, b)]
            groups.append("|".join(sides))
            begin = end
        aligned.append((a, b, links, groups))
        counts.update(links)
    most = Counter()
    for (_, second), n in counts.items():
        most[second] = max(most[second], n)
    return [
        (
            len(a), len(b), len(groups), len(links), sum(counts[x] == most[x[1]] for x in links),
            sum(counts[x] for x in links), sha256(";".join(groups).encode()).hexdigest() if a else "",
        )
        for a, b, links, groups in aligned
    ]


def found_rows(spark, texts, **options):
    rows = [(i, text, 5, [1]) for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a int, pairs array<int>").repartition(3)
    found = alignment.cross_tokenizer(docs, *FILES, **options)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return [tuple(r)[1:] for r in sorted(found.collect())]


@pytest.mark.parametrize("most_pairs", [1 << 20, 200, 0])
def test_rows_equal_plain_loops(spark, documents, plain, most_pairs):
    """With all pairs known to every task, with the frequent ones only, and with none."""
    texts = TEXTS + [d["text"][:1500] for d in documents[:60]] + TEXTS[5:8]
    assert found_rows(spark, texts, most_pairs=most_pairs) == plain_rows(texts, plain)


def test_long_texts_in_parts(documents, plain, monkeypatch):
    long = " ".join(t for t in TEXTS if t and "▁" not in t)
    texts = [*TEXTS, long, *(d["text"][:1200] for d in documents[:12]), "没有空格，也行。再来一句！" * 50, "no-blank;but,signs." * 90]
    expected = plain_rows(texts, plain)
    tools = alignment.Tools(*(open(f, "rb").read() for f in FILES))
    for size in (1, 7, 100):
        monkeypatch.setattr(alignment, "UNIT_CHARS", size)
        rows = alignment.BatchOfRows(len(texts), tools)
        for i, text in enumerate(texts):
            units = tools.units(text)
            assert "".join(units) == (" " + text if text else "")
            assert size > 1 or not text or len(text) < 200 or len(text.strip("a ")) == 0 or len(units) > 10
            for unit in units:
                rows.add([(i, unit)])
        *sums, digests, pairs, times = (c.to_pylist() for c in rows.columns())
        assert list(zip(*sums, strict=True)) == [r[:4] for r in expected]
        assert digests == [r[6] for r in expected]
        assert [sum(t) for t in times] == [r[3] for r in expected]


def test_both_byte_level_encoders_agree(documents):
    tools = alignment.Tools(*(open(f, "rb").read() for f in FILES))
    for text in [" " + t for t in TEXTS if t] + [" " + d["text"] for d in documents[:100]]:
        slow = tools.slow.encode(text, add_special_tokens=False).ids
        assert tools.fast.encode_ordinary(text) == slow
        assert tools.byte_level_ids(text, text.encode()).tolist() == slow


def test_a_very_long_run_takes_no_quadratic_time():
    tools = alignment.Tools(*(open(f, "rb").read() for f in FILES))
    rows = alignment.BatchOfRows(1, tools)
    rows.add([(0, " " + "ab" * 150_000)])
    assert rows.columns()[3].to_pylist()[0] > 100_000


def test_equal_counts_are_all_best(spark):
    (row,) = found_rows(spark, ["one two"])
    assert row[3] == row[4] == row[5] > 0


def test_empty_table_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, None)], "doc_id long, text string")
    found = sorted(map(tuple, alignment.cross_tokenizer(docs, *FILES).collect()), key=repr)
    assert [r[0] for r in found] == [3, None, None] and found[0][1:] == (0, 0, 0, 0, 0, 0, "")
    assert found[1] == found[2] and found[1][6] == 2 * found[1][4]
    assert alignment.cross_tokenizer(docs.limit(0), *FILES).count() == 0


def test_overlaps_by_document():
    frame = alignment.pd.DataFrame
    a = frame({"at": [0, 2, 5, 9], "doc": [0, 0, 0, 1], "a": [0, 1, 2, 3]})
    b = frame({"at": [0, 1, 5, 9, 10], "doc": [0, 0, 0, 1, 1], "b": [0, 1, 2, 3, 4]})
    found = alignment.overlaps(a, b)
    assert sorted(map(tuple, found.to_numpy().tolist())) == [(0, 0), (0, 1), (1, 1), (2, 2), (3, 3), (3, 4)]
    assert found.dtypes.eq(np.int64).all()
