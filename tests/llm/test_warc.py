"""Archives written and read back against plain Python."""

from __future__ import annotations

import gzip
import io
from base64 import b32encode
from hashlib import sha1

import pytest

from helpers import bag
from meterline.llm import warc

TRICKY = [
    (5, "http://a/", "same"),
    (3, "http://b/\r\nWARC-Type: resource", "same"),
    (9, None, "same"),
    (1, "http://c/", None),
    (2, "http://d/", ""),
    (4, "http://e/ü", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (6, "http://f/", "line\r\n\r\nline\n\n"),
    (7, "http://g/", "ü€😀" * 3),
    (8, "http://h/", "x" * 300_000),
    (10, "http://h/", "x" * 300_000),
]


def expected(rows, min_bytes=0):
    first = {}
    for key, _, text in rows:
        data = (text or "").encode()
        if key is not None:
            first[data] = min(key, first.get(data, key))
    out = []
    for key, _, text in rows:
        data = (text or "").encode()
        again = len(data) >= min_bytes and data in first and key != first[data]
        digest = b32encode(sha1(data).digest()).decode()
        out.append((key, len(data), digest, "revisit" if again else "response", first[data] if again else None))
    return sorted(out, key=repr)


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, payload_bytes string")


@pytest.mark.parametrize("min_bytes", [0, 1, 5])
def test_tricky_payloads(spark, min_bytes):
    got = warc.revisit_resolution(pages_of(spark, TRICKY), min_bytes=min_bytes)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert bag(got) == expected(TRICKY, min_bytes)


def test_nulls_and_repeats(spark):
    rows = [(1, "u", "a"), (1, "u", "a"), (None, "u", "a"), (None, None, "b"), (2, None, "a")]
    got = bag(warc.revisit_resolution(pages_of(spark, rows)))
    assert got == expected(rows)


def test_empty_table(spark):
    assert warc.revisit_resolution(pages_of(spark, [])).count() == 0


def test_archives_are_of_the_format(spark, tmp_path):
    path = str(tmp_path / "archives")
    warc.write_archives(pages_of(spark, TRICKY), path, archive_bytes=200_000)
    files = sorted((tmp_path / "archives").glob("*.gz"))
    assert len(files) == 4
    found = []
    for file in files:
        with gzip.open(file) as unpacked:
            found += list(warc.records(io.BufferedReader(unpacked)))
    assert len(found) == len(TRICKY)
    ids = {fields["warc-record-id"] for fields, _ in found}
    assert len(ids) == len(TRICKY)
    texts = {key: (text or "").encode() for key, _, text in TRICKY}
    for fields, block in found:
        head, _, payload = block.partition(b"\r\n\r\n")
        assert head.startswith(b"HTTP/1.1 200 OK")
        assert fields["warc-date"].endswith("Z")
        if fields["warc-type"] == "response":
            assert payload == texts[int(fields["x-key"])]
            assert "warc-refers-to" not in fields
        else:
            assert payload == b""
            assert fields["warc-refers-to"] in ids
            assert fields["warc-profile"].endswith("identical-payload-digest")
    assert sum(fields["warc-type"] == "revisit" for fields, _ in found) == 4


def test_a_changed_payload_is_noticed(spark, tmp_path):
    path = tmp_path / "archives"
    warc.write_archives(pages_of(spark, TRICKY[:1]), str(path))
    (file,) = path.glob("*.gz")
    data = gzip.decompress(file.read_bytes())
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "a.gz").write_bytes(gzip.compress(data.replace(b"same", b"lame")))
    with pytest.raises(Exception, match="changed"):
        warc.read_archives(spark, str(tmp_path / "bad")).collect()


@pytest.mark.parametrize("broken", [b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc", b"nonsense"])
def test_broken_archives(broken):
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(broken)))
