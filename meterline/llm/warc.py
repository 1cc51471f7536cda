"""WARC archives with revisit records in place of repeated payloads.

Digests of all payloads are shuffled and the smallest id of each becomes its original; a
join tells every record whether it is the response or a revisit of it. Archives are text
files with CRLF between records, so Spark's own writer makes them and its commit protocol
survives lost tasks. They are read back record by record by their stated lengths.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from base64 import b32encode
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.columns import hidden, in_batches
from meterline.session import cut_lineage, new_folder

# Fixed values of the format.
VERSION = "WARC/1.1"
BREAK = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32, CONV32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"

ARCHIVE_BYTES = 16 << 20  # of payload in one archive, which one task reads back


def base32_sha1(data: Column) -> Column:
    """The SHA-1 of a column in base 32: five hex digits are four digits of base 32."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*groups), CONV32, BASE32)


def record_uri(*parts: Column) -> Column:
    """A stable record id, named by a hash of what the record holds."""
    h = F.sha2(F.concat_ws("\n", *parts), 256)
    cut = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 3), (17, 3), (21, 12))]
    return F.format_string("<urn:uuid:%s-%s-5%s-8%s-%s>", *cut)


def header(name: str, value: Column) -> Column:
    """A header line, or nothing for a null. Line breaks in a value become blanks."""
    clean = F.regexp_replace(value.cast("string"), r"[\x00-\x1F\x7F]", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(BREAK)), F.lit(""))


def resolved(captures: DataFrame, min_bytes: int) -> DataFrame:
    """``_digest`` and ``_original``, the smallest id of each payload long enough to resolve."""
    heads = captures.filter(F.col("_bytes") >= min_bytes).select("_digest", "_id")
    return heads.groupBy("_digest").agg(F.min("_id").alias("_original"), F.count("*").alias("_n")).filter(
        "_n > 1"
    ).select(F.col("_digest").alias("_of"), "_original")


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
    date: datetime | None = None,
) -> None:
    """Write one record for each row of ``pages`` as compressed archives in ``path``.

    The payload is the text in UTF-8, a null counts as empty. Of equal payloads of at least
    ``min_bytes`` bytes the one with the smallest id is a response, the others revisits of
    it; shorter ones are all responses, and so are payloads whose ids are all null. A row
    that repeats both id and payload of an original is a response too. A null url is left
    out; control characters in it become blanks. An empty table makes no record.
    """
    source, names = hidden(pages.select(id_col, url_col, payload_col))
    key, url, payload = names
    text = F.coalesce(F.col(payload), F.lit(""))
    captures = source.select(
        F.col(key).alias("_id"),
        F.col(url).alias("_url"),
        text.alias("_text"),
        base32_sha1(text).alias("_digest"),
        F.octet_length(text).cast("long").alias("_bytes"),
    )
    originals = cut_lineage(resolved(captures, min_bytes))
    joined = captures.join(
        originals, (F.col("_digest") == F.col("_of")) & (F.col("_bytes") >= min_bytes), "left"
    )
    revisit = F.coalesce(F.col("_original") != F.col("_id"), F.col("_id").isNull() & F.col("_original").isNotNull())
    at = (date or datetime.now(UTC)).astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    own_type = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK" + BREAK + "Content-Type: text/html; charset=utf-8" + BREAK),
        header("Content-Length", F.col("_bytes")),
        F.lit(BREAK),
    )
    name = F.coalesce(F.col("_id").cast("string"), F.lit("null"))
    original_name = F.col("_original").cast("string")
    head = F.concat(
        F.lit(VERSION + BREAK),
        header("WARC-Type", own_type),
        header("WARC-Record-ID", record_uri(own_type, name, F.col("_digest"))),
        header("WARC-Date", F.lit(at)),
        header("WARC-Target-URI", F.col("_url")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
        F.when(
            revisit,
            F.concat(
                header("WARC-Profile", F.lit(PROFILE)),
                header("WARC-Refers-To", record_uri(F.lit("response"), original_name, F.col("_digest"))),
                header("X-Refers-To-Key", F.col("_original")),
            ),
        ).otherwise(F.lit("")),
        header("X-Key", F.col("_id")),
        header("Content-Type", F.lit("application/http;msgtype=response")),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("_text"))
    length = F.octet_length(http) + F.octet_length(body)
    record = F.concat(head, header("Content-Length", length), F.lit(BREAK), http, body, F.lit(BREAK))

    total = pages.agg(F.sum(F.octet_length(payload_col))).first()[0] or 0
    archives = max(1, -(-total // archive_bytes))
    # The writer ends each record with the second line break that the format asks for.
    spread = joined.select(record.alias("value"), F.xxhash64("_id", "_digest", "_url").alias("_at"))
    spread.repartition(archives, "_at").select("value").write.text(
        path, compression="gzip", lineSep=BREAK
    )


def records(file: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, with lower-case names, and block of each record of an archive."""
    while line := file.readline():
        if line.strip() != VERSION.encode():
            raise ValueError(f"not the first line of a record: {line[:40]!r}")
        fields = {}
        while (line := file.readline()).strip():
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        length = int(fields["content-length"])
        block = file.read(length)
        if len(block) != length or file.read(4) != b"\r\n\r\n":
            raise ValueError("the record is cut off")
        yield fields, block


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record: its key, type, digest, payload bytes and the key it refers to.

    The payload of every response is hashed again; a digest that differs from its header
    raises. Keys are strings; payload bytes of a revisit are null. A folder without archives
    gives an empty table.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = []
                with gzip.GzipFile(fileobj=io.BytesIO(batch.column(0)[i].as_py())) as unpacked:
                    for fields, block in records(io.BufferedReader(unpacked)):
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        kind, size = fields["warc-type"], None
                        if kind == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            size = len(payload)
                            if b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                                raise ValueError(f"the payload of {fields['warc-record-id']} changed")
                        rows.append((fields.get("x-key"), kind, digest, size, fields.get("x-refers-to-key")))
                        if len(rows) == 4096:
                            yield batch_of(rows)
                            rows = []
                yield batch_of(rows)

    return in_batches(files.select("content"), parse, "key string, record_type string, payload_digest string, payload_bytes long, refers_to string"
    )


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
    names = ["key", "record_type", "payload_digest", "payload_bytes", "refers_to"]
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )


def with_payload_bytes(read: DataFrame) -> DataFrame:
    """Every revisit joined to its response, whose payload has the bytes it stands for."""
    read = cut_lineage(read)
    sizes = read.filter("record_type = 'response'").groupBy(F.col("payload_digest").alias("_of")).agg(
        F.max("payload_bytes").alias("_size")
    )
    missing = read.filter(F.col("record_type") == "revisit").select("key", "record_type", "payload_digest", "refers_to")
    found = missing.join(sizes, F.col("payload_digest") == F.col("_of"), "left")
    whole = read.filter("record_type = 'response'")
    return whole.unionByName(found.drop("_of").withColumnRenamed("_size", "payload_bytes"))


def revisit_resolution(
    pages: DataFrame, id_col: str = "page_id", path: str | None = None, **options
) -> DataFrame:
    """Write the archives of ``pages`` to ``path``, or below the shared folder, and read them.

    One row for each page: its id, payload_bytes, payload_digest, record_type, refers_to.
    """
    path = path or new_folder(pages.sparkSession, "archives")
    write_archives(pages, path, id_col=id_col, **options)
    kind = pages.schema[id_col].dataType
    read = with_payload_bytes(read_archives(pages.sparkSession, path))
    return read.select(
        F.col("key").cast(kind).alias(id_col),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
