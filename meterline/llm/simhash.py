"""Near duplicates by SimHash fingerprints that differ in few bits.

A fingerprint of 64 bits is cut into segments of 23, 23 and 18 bits. If two fingerprints
differ in at most three bits, then either one segment is equal and another differs in at
most one bit, or each segment differs in one bit. A segment that may differ in one bit is
replaced by the number of its nearest Golay codeword: one side of the join takes that
number alone, the other the numbers of all codewords near it, one or six. So all pairs that
may link meet in a join on keys of 30 to 36 bits, and are then compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm import golay
from meterline.llm.columns import by_slices, hidden, in_batches, shown, shuffle_partitions
from meterline.llm.components import components
from meterline.session import cut_lineage

# The bits of the segments, their lowest bits, and the seed of the hash.
SEGMENTS, LOWEST = (23, 23, 18), (0, 23, 46)
SEED = 42
MOST_BITS = 3
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """The SimHash of all shingles of words, repeats included; 0 if there is no word."""
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), HASHES_AT_ONCE):
        spans = zip(starts[at : at + HASHES_AT_ONCE], ends[at : at + HASHES_AT_ONCE], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    most = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(most.view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """``docs`` without the text and with ``_fp``, the fingerprint as a signed long."""

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_slices(batches, "_text"):
            found = [fingerprint(text or b"", shingle) for text in batch.column("_text").to_pylist()]
            column = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            rest = batch.drop_columns(["_text"])
            yield rest.append_column("_fp", column)

    rest = [c for c in docs.columns if c != text_col]
    plain = docs.select(*rest, F.col(text_col).cast("binary").alias("_text"))
    schema = T.StructType([*docs.select(*rest).schema.fields, T.StructField("_fp", T.LongType())])
    return in_batches(plain, compute, schema)


def keys_of(values: np.ndarray) -> Iterator[tuple[bool, np.ndarray, np.ndarray]]:
    """All keys of some fingerprints: the side of the join, row numbers and keys.

    A key holds its kind in the top bits: for each ordered pair of segments, the first whole
    and the codeword number of the second; and the codeword numbers of all three.
    """
    n = len(values)
    every = np.arange(n)
    parts = [
        ((values >> np.uint64(low)) & np.uint64((1 << size) - 1)).astype(np.uint32)
        for size, low in zip(SEGMENTS, LOWEST, strict=True)
    ]
    own = [golay.index(part).astype(np.uint64) for part in parts]
    near = [golay.near_indices(part) for part in parts]
    kind = 0
    for whole in range(3):
        for other in range(3):
            if whole == other:
                continue
            base = (np.uint64(kind) << np.uint64(40)) | (parts[whole].astype(np.uint64) << np.uint64(12))
            yield False, every, base | own[other]
            codes, valid = near[other]
            rows, columns = np.nonzero(valid)
            yield True, rows, base[rows] | codes[rows, columns].astype(np.uint64)
            kind += 1
    base = np.uint64(kind) << np.uint64(40)
    (a, a_valid), (b, b_valid), (c, c_valid) = near
    rows, columns = np.nonzero(c_valid)
    key = base | (own[0][rows] << np.uint64(24)) | (own[1][rows] << np.uint64(12))
    yield False, rows, key | c[rows, columns].astype(np.uint64)
    rows, i, j = np.nonzero(a_valid[:, :, None] & b_valid[:, None, :])
    key = base | (a[rows, i].astype(np.uint64) << np.uint64(24))
    yield True, rows, key | (b[rows, j].astype(np.uint64) << np.uint64(12)) | own[2][rows]


def key_rows(distinct: DataFrame, wide: bool) -> DataFrame:
    """The keys of one side of the join: ``_key`` and the fingerprint under ``_a`` or ``_b``."""
    name = "_a" if wide else "_b"

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                signed = batch.column(0).slice(at, 4096).to_numpy()
                for side, rows, keys in keys_of(signed.view(np.uint64)):
                    if side == wide:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys.view(np.int64)), pa.array(signed[rows])], ["_key", name]
                        )

    return in_batches(distinct, emit, f"_key long, {name} long")


def close_pairs(distinct: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """All pairs a < b of the fingerprints in ``_fp`` that differ in 1 to ``most_bits`` bits."""
    if not 0 <= most_bits <= MOST_BITS:
        raise ValueError(f"the keys find differences of up to {MOST_BITS} bits")
    # A fingerprint makes about 70 keys, so the few bytes of many are spread before.
    spread = distinct.repartition(shuffle_partitions(distinct), "_fp")
    met = key_rows(spread, True).join(key_rows(spread, False), "_key")
    differing = F.bit_count(F.col("_a").bitwiseXOR(F.col("_b")))
    return met.filter(differing.between(1, most_bits)).select(
        F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")
    ).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """One row for each row of ``docs``: its id, fingerprint and component_id.

    Fingerprints are 16 lower-case hex digits. Texts without a word, also null and empty
    ones, have fingerprint zero and link like any other. Rows whose fingerprints differ in at
    most ``most_bits`` bits are linked; component_id is the smallest id that links reach. Rows
    with a null id take part and lend no id; a component of such rows alone has a null one.
    Repeated rows give repeated results, an empty table none; other columns are not read.
    """
    source, names = hidden(docs.select(id_col, text_col))
    key, text = names
    found = cut_lineage(fingerprints(source, text, shingle))
    firsts = cut_lineage(found.groupBy("_fp").agg(F.min(key).alias("_first")))
    linked = cut_lineage(components(close_pairs(firsts.select("_fp"), most_bits)))
    rooted = firsts.join(linked, F.col("_fp") == F.col("node"), "left")
    rooted = rooted.withColumn("_root", F.coalesce("root", "_fp"))
    smallest = rooted.groupBy("_root").agg(F.min("_first").alias("component_id"))
    of_print = rooted.select("_fp", "_root").join(smallest, "_root").select("_fp", "component_id")
    result = found.join(of_print, "_fp").withColumn(
        "fingerprint", F.lower(F.lpad(F.hex("_fp"), 16, "0"))
    )
    return shown(result, {key: id_col}, "fingerprint", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component; null ids stay.

    Rows that share an id are decided together: all go if one of them is not the first.
    """
    found = near_duplicates(docs, id_col=id_col, **options)
    away = found.filter(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    return docs.join(away, id_col, "left_anti").select(*docs.columns)
