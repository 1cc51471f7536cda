"""Importance resampling of documents towards the word features of a target corpus.

Features are runs of one to three words, hashed into buckets by CRC-32. A bucket's gain says
how much more frequent it is in the target; a document weighs the gains of its features, and
a Gumbel variate from its id turns the highest weights into a draw without replacement.

The checksums are computed for whole batches: the distinct features of a batch are grouped by
their length into matrices of bytes, one feature a row, and all checksums of a matrix advance
together, column by column. Each occurrence then takes its bucket back by its feature's number.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.columns import by_slices, hidden, in_batches, shown
from meterline.llm.ranking import RANGE, spread_ranges
from meterline.session import cut_lineage

# The size of the hashed feature space, the longest run of words, and the share
# and length of the documents that are drawn.
BUCKETS = 10_000
LONGEST_RUN = 3
SHARE_PERCENT, LEAST_WORDS, SEED = 5, 20, 42
CRC_POLYNOMIAL = 0xEDB88320

SLICE_BYTES = 2 << 20
ROWS_AT_ONCE = 1 << 15  # of a matrix, so that its checksums stay in the processor's cache
WIDEST = 256  # columns; longer features take several rows


@cache
def crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(CRC_POLYNOMIAL), table >> 1)
    return table


def crc_columns(matrix: np.ndarray, start: int) -> np.ndarray:
    """The checksum register of every row, all advanced by one column after the other."""
    table = crc_table()
    out = np.empty(len(matrix), np.uint32)
    for at in range(0, len(matrix), ROWS_AT_ONCE):
        columns = np.ascontiguousarray(matrix[at : at + ROWS_AT_ONCE].T)
        crc = np.full(columns.shape[1], start, np.uint32)
        for column in columns:
            crc = table[crc.astype(np.uint8) ^ column] ^ (crc >> 8)
        out[at : at + ROWS_AT_ONCE] = crc
    return out


@cache
def skip_tables(rows: int) -> np.ndarray:
    """What ``rows`` (a power of two) times ``WIDEST`` zero bytes make of a register's bytes."""
    if rows > 1:
        return skipped(skip_tables(rows // 2), rows // 2)
    crc = np.left_shift(np.arange(256, dtype=np.uint32), np.arange(0, 32, 8, dtype=np.uint32)[:, None])
    for _ in range(WIDEST):
        crc = crc_table()[crc & 0xFF] ^ (crc >> 8)
    return crc


def skipped(crc: np.ndarray, rows: int) -> np.ndarray:
    """Registers after ``rows`` times ``WIDEST`` further zero bytes."""
    tables = skip_tables(rows)
    return (
        tables[0][crc & 0xFF] ^ tables[1][crc >> 8 & 0xFF]
        ^ tables[2][crc >> 16 & 0xFF] ^ tables[3][crc >> 24]
    )


def crc_of_long(stream: np.ndarray, starts: np.ndarray, rows: int, lengths: np.ndarray) -> np.ndarray:
    """Checksums of features that fill ``rows`` rows of a matrix each, the first padded in front.

    Zeros in front leave a register of zero as it is; what the register starts with goes into
    the first four bytes instead. Neighbouring rows are joined in pairs, as a checksum is
    linear: the left one is moved on by as many zero bytes as the right one covers.
    """
    matrix = np.zeros((len(starts), rows * WIDEST), np.uint8)
    for row, start, length in zip(matrix, starts.tolist(), lengths.tolist(), strict=True):
        row[-length:] = stream[start : start + length]
        row[len(row) - length : len(row) - length + 4] ^= 0xFF
    crc = crc_columns(matrix.reshape(-1, WIDEST), 0).reshape(len(starts), rows)
    covered = 1
    while crc.shape[1] > 1:
        if crc.shape[1] % 2:
            crc = np.concatenate([np.zeros((len(crc), 1), np.uint32), crc], axis=1)
        crc = skipped(crc[:, 0::2], covered) ^ crc[:, 1::2]
        covered *= 2
    return crc[:, 0]


def checksums(stream: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of the byte runs of a stream, one matrix for each length."""
    out = np.empty(len(starts), np.uint32)
    rows = -(-lengths // WIDEST)
    kinds = np.where(lengths <= WIDEST, lengths, WIDEST + rows)
    order = np.argsort(kinds, kind="stable")
    edges = np.flatnonzero(np.diff(kinds[order], prepend=-1, append=-1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        same = order[a:b]
        if (kind := int(kinds[same[0]])) <= WIDEST:
            matrix = np.lib.stride_tricks.sliding_window_view(stream, kind)[starts[same]]
            out[same] = crc_columns(matrix, 0xFFFFFFFF)
        else:
            step = max(1, SLICE_BYTES // ((kind - WIDEST) * WIDEST))
            for at in range(0, len(same), step):
                some = same[at : at + step]
                out[some] = crc_of_long(stream, starts[some], kind - WIDEST, lengths[some])
    return out ^ np.uint32(0xFFFFFFFF)


@cache
def byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """Each byte with A-Z made small, and whether it belongs to a word: 0-9, a-z, all of 128 on."""
    small = np.arange(256, dtype=np.uint8)
    small[ord("A") : ord("Z") + 1] += 32
    word = np.zeros(256, bool)
    word[ord("0") : ord("9") + 1] = word[ord("a") : ord("z") + 1] = word[128:] = True
    return small, word


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of equal keys, and where each number comes first."""
    codes, distinct = pd.factorize(keys)
    first = np.empty(len(distinct), np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return codes, first


class Words:
    """The words of some texts in bytes; ``known`` words in front of each were counted before."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, known: np.ndarray):
        small, is_word = byte_classes()
        data = small[data]
        inside = is_word[data]
        filled = np.diff(offsets) > 0
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        begins[offsets[:-1][filled]] = inside[offsets[:-1][filled]]
        ends[offsets[1:][filled] - 1] = inside[offsets[1:][filled] - 1]
        self.starts = np.flatnonzero(begins)
        self.sizes = np.flatnonzero(ends) + 1 - self.starts
        self.edges = np.searchsorted(self.starts, offsets)  # of the texts among the words
        self.known = np.minimum(known, np.diff(self.edges))
        self.letters = data[inside]
        # One blank behind each word, so a run of words is one run of bytes.
        self.places = np.cumsum(self.sizes + 1) - (self.sizes + 1)
        self.stream = np.full(len(self.letters) + len(self.starts), 0x20, np.uint8)
        letter = np.ones(len(self.stream), bool)
        letter[self.places + self.sizes] = False
        self.stream[letter] = self.letters

    def buckets(self, buckets: int) -> list[np.ndarray]:
        """For runs of one, two and three words that end at each word, the bucket, or -1."""
        n = len(self.starts)
        found = [np.full(n, -1, np.int64) for _ in range(LONGEST_RUN)]
        if not n:
            return found
        offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), n, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.letters)]
        )
        codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
        n_words = int(codes.max()) + 1
        place = np.arange(n) - np.repeat(self.edges[:-1], np.diff(self.edges))
        fresh = place >= np.repeat(self.known, np.diff(self.edges))
        keys, last = codes, np.arange(n)  # of the runs, and the word at which each ends
        for length in range(1, LONGEST_RUN + 1):
            if length > 1:
                longer = place[last] >= length - 1
                keys, last = keys[np.searchsorted(last, last[longer] - 1)], last[longer]
                keys = keys * n_words + codes[last]
            keys, first = numbered(keys)
            end = last[first]
            start = self.places[end - (length - 1)]
            crc = checksums(self.stream, start, self.places[end] + self.sizes[end] - start)
            found[length - 1][last] = (crc % buckets)[keys]
        for run in found:
            run[~fresh] = -1
        return found

    def counts(self) -> np.ndarray:
        return np.diff(self.edges) - self.known


def segments(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, Words, bool]]:
    """Batches in slices with the words of their texts; of a longer text, words of each part.

    A part of a text begins with the last words of the part before, which are known. The
    flag tells that the batch ends with these words.
    """
    for batch in by_slices(batches, column, SLICE_BYTES):
        texts = pc.fill_null(batch.column(column), "").cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        if len(texts) > 1 or len(data) <= 2 * SLICE_BYTES:
            yield batch, Words(data, offsets, np.zeros(len(texts), np.int64)), True
            continue
        small, is_word = byte_classes()
        begin = end = known = 0
        while True:
            end += 2 * SLICE_BYTES
            while end < len(data) and not (gaps := np.flatnonzero(~is_word[small[data[end : end + 4096]]])).size:
                end += 4096
            end = min(len(data), end + int(gaps[0])) if end < len(data) else len(data)
            part = Words(data[begin:end], np.array([0, end - begin]), np.array([known]))
            yield batch, part, end == len(data)
            if end == len(data):
                break
            known = min(LONGEST_RUN - 1, len(part.starts))
            begin = begin + int(part.starts[-known]) if known else end


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; ``buckets`` numbers reach the driver.

    A task adds up all its texts before anything is shuffled.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets + 1, np.int64)
        for _, words, _ in segments(batches, "text"):
            for run in words.buckets(buckets):
                total += np.bincount(run + 1, minlength=buckets + 1)
        at = np.flatnonzero(total[1:])
        yield pa.record_batch({"bucket": pa.array(at, pa.int32()), "n": pa.array(total[1 + at])})

    counted = in_batches(docs.select(F.col(text_col).alias("text")), count, "bucket int, n long")
    found = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[row.bucket] = row.n
    return found


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain: a thousandth of the logarithm of how much more often the target has it.

    One is added to every count, so that no gain is infinite.
    """
    total, goal = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.floor(1000 * np.log((target + 1.0) * total / ((source + 1.0) * goal))).astype(np.int64)


def fit(docs: DataFrame, target: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """The gains of all buckets, from all documents and all texts of the target."""
    return gains_of(bucket_counts(docs, text_col, buckets), bucket_counts(target, text_col, buckets))


def weigh(docs: DataFrame, gains: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, n_features and weight, the sum of its features' gains."""
    source, names = hidden(docs)
    column = next(k for k, name in names.items() if name == text_col)
    shared = docs.sparkSession.sparkContext.broadcast(np.append(gains, 0))

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((3, 0), np.int64)
        for batch, words, whole in segments(batches, column):
            gain = shared.value
            each = sum(gain[run] for run in words.buckets(len(gain) - 1))
            sums = np.concatenate([[0], np.cumsum(each)]) if len(words.starts) else np.zeros(1, np.int64)
            n = words.counts()
            before = held[0] if held.size else np.zeros(len(n), np.int64)
            # A run of words counts where it ends, the first words of a text end fewer.
            short = [np.clip(n + before - k, 0, None) - np.clip(before - k, 0, None) for k in range(LONGEST_RUN)]
            rows = np.array([n, sum(short), sums[words.edges[1:]] - sums[words.edges[:-1]]])
            held = held + rows if held.size else rows
            if whole:
                made = dict(zip(RESULTS, held, strict=True))
                held = np.zeros((3, 0), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *(pa.array(v, pa.int64()) for v in made.values())],
                    [*batch.schema.names, *made],
                )

    schema = T.StructType([*source.schema.fields, *(T.StructField(name, T.LongType()) for name in RESULTS)])
    return shown(in_batches(source, compute, schema), names, *RESULTS)


RESULTS = ("n_words", "n_features", "weight")


def draw(
    weighed: DataFrame,
    id_col: str = "doc_id",
    percent: int = SHARE_PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``weighed`` with score, and rank for the highest scores among documents of enough words.

    ``percent`` of those documents are drawn, rounded down; ties go to the smaller id, rows
    of one id and score in any order. Scores are cut into even ranges; only those that reach
    into the draw are sorted, each in a task.
    """
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("")))
    uniform = (F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long") + 0.5) / 4294967296
    noise = F.floor(-1000 * F.log(-F.log(uniform)))
    keyed = weighed.withColumnRenamed(id_col, "_id")
    scored = keyed.withColumns({"score": F.col("weight") + noise, "_row": F.monotonically_increasing_id()})
    stored = cut_lineage(scored).withColumn("_falling", -F.col("score"))
    able = stored.filter(F.col("n_words") >= least_words)
    tagged, ranges = spread_ranges(able, "_falling", "_id", "_row")
    sizes = dict(tagged.groupBy(RANGE).count().collect())
    wanted = percent * sum(sizes.values()) // 100
    before, starts = 0, []
    for number in range(ranges):
        starts.append(before)
        before += sizes.get(number, 0)
    reached = sum(start < wanted for start in starts)
    inside = W.partitionBy(RANGE).orderBy("_falling", "_id", "_row")
    drawn = tagged.filter(F.col(RANGE) < reached).repartitionById(max(1, reached), F.col(RANGE))
    start = F.get(F.array(*[F.lit(s).cast("long") for s in starts[:reached] or [0]]), F.col(RANGE))
    place = (start + F.row_number().over(inside)).alias("rank")
    drawn = drawn.select("_row", place).filter(F.col("rank") <= wanted)
    rest = stored.join(drawn, "_row", "left")
    return rest.drop("_row", "_falling").withColumnRenamed("_id", id_col)


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = BUCKETS,
    percent: int = SHARE_PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """One row for each document: id, n_words, n_features, weight, score and rank.

    Reads all texts twice, once for the counts of the buckets and once for the weights; only
    the counts and the scores are shuffled. A null or empty text has no words, weight 0 and no rank;
    a null id has the score of an empty one. Repeated rows are documents each. Texts of any
    length are read whole, in parts that overlap by two words. An empty table gives an empty
    result; other columns are not read.
    """
    chosen = docs.select(id_col, text_col)
    gains = fit(chosen, target, text_col, buckets)
    weighed = weigh(chosen, gains, text_col).drop(text_col)
    return draw(weighed, id_col, percent, least_words, seed)
