"""Packing of tokenised documents into sequences of bounded length.

Pieces are spread over tasks by a hash; each task runs an online best fit: a piece goes into
the open sequence with the least room that takes it. A bitset has a bit for each amount of
room that an open sequence has, so the fit is the lowest bit at or above the piece's length.
A fixed number of sequences is open; one more, and the fullest closes. A task takes its
pieces longest first, so the short ones fill what the long ones leave.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.bpe import encoder
from meterline.llm.columns import by_slices, hidden, in_batches
from meterline.session import cut_lineage

CAPACITY = 2048
OPEN_SEQUENCES = 16_384
PIECES_PER_TASK = 40_000
END_ID = 0

PIECES = "_id {kind}, piece int, start long, length long, ids_crc32 long"


class BestFit:
    """Places lengths into sequences one by one; it remembers ``most_open`` sequences."""

    def __init__(self, capacity: int = CAPACITY, most_open: int = OPEN_SEQUENCES):
        self.capacity, self.most_open = capacity, most_open
        self.rooms = 0  # bit r is set if an open sequence has room r
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = self.opened = 0

    def take(self, room: int) -> int:
        sequences = self.by_room[room]
        sequence = sequences.pop()
        if not sequences:
            self.rooms &= ~(1 << room)
        self.open -= 1
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        """The number of the sequence and the place in it."""
        if not 0 < length <= self.capacity:
            raise ValueError(f"a piece has 1 to {self.capacity} tokens, not {length}")
        fits = self.rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            sequence = self.take(room)
        else:
            room, sequence = self.capacity, self.opened
            self.opened += 1
        left = room - length
        if left:
            self.by_room[left].append(sequence)
            self.rooms |= 1 << left
            self.open += 1
            if self.open > self.most_open:
                self.take((self.rooms & -self.rooms).bit_length() - 1)
        return sequence, self.capacity - room


def cut_pieces(
    docs: DataFrame, path: str, id_col: str, text_col: str, capacity: int
) -> DataFrame:
    """One row for each run of ``capacity`` tokens of a document, the last may be shorter."""
    source, names = hidden(docs.select(id_col, text_col))
    key, text = names
    schema = PIECES.format(kind=source.schema[key].dataType.simpleString())

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 4 * capacity
        for batch in by_slices(batches, text):
            rows: list[tuple] = []
            owners: list[int] = []
            for i, whole in enumerate(batch.column(text).to_pylist()):
                held, piece = b"", 0
                for block in [*encoder(path).stream(whole or ""), END_ID.to_bytes(4, "little")]:
                    held += block
                    while len(held) > size:
                        rows.append((piece, piece * capacity, capacity, zlib.crc32(held[:size])))
                        owners.append(i)
                        held, piece = held[size:], piece + 1
                rows.append((piece, piece * capacity, len(held) // 4, zlib.crc32(held)))
                owners.append(i)
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).take(pa.array(owners, pa.int64())),
                    pa.array(columns[0], pa.int32()),
                    *(pa.array(c, pa.int64()) for c in columns[1:]),
                ],
                ["_id", "piece", "start", "length", "ids_crc32"],
            )

    return in_batches(source, compute, schema)


def placed(pieces: DataFrame, capacity: int, most_open: int) -> DataFrame:
    """``pieces`` with sequence_id and offset; the partitions pack on their own."""

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, first = BestFit(capacity, most_open), TaskContext.get().partitionId() << 32
        for batch in batches:
            places = [fit.place(n) for n in batch.column("length").to_pylist()]
            yield batch.append_column(
                "sequence_id", pa.array([first + s for s, _ in places], pa.int64())
            ).append_column("offset", pa.array([at for _, at in places], pa.int64()))

    added = [T.StructField(name, T.LongType()) for name in ("sequence_id", "offset")]
    schema = T.StructType([*pieces.schema.fields, *added])
    return in_batches(pieces, compute, schema)


def pack(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    most_open: int = OPEN_SEQUENCES,
    pieces_per_task: int = PIECES_PER_TASK,
) -> DataFrame:
    """One row for each piece of each document: where it lies in its document and sequence.

    A document is its tokens in the vocabulary of ``path`` and an end id 0; a null or empty
    text is that id alone. Only documents longer than ``capacity`` are cut. Columns: the id,
    piece, start, length, ids_crc32, sequence_id, offset. Pieces of a sequence lie without
    gaps from offset 0. Sequences of one full piece need no packing and are numbered below
    zero. Every task leaves a few sequences unfilled at its end, a share that falls with
    ``pieces_per_task``. Null ids and repeated rows are documents of their own; an empty
    table gives an empty result; other columns are not read.
    """
    pieces = cut_lineage(cut_pieces(docs, path, id_col, text_col, capacity))
    full = pieces.filter(F.col("length") == capacity).select(
        "*",
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    short = pieces.filter(F.col("length") < capacity)
    tasks = max(1, -(-short.count() // pieces_per_task))
    spread = short.repartition(tasks, F.xxhash64("_id", "piece", "ids_crc32", "length"))
    # A full order, so a task that runs again after a loss packs the same.
    ordered = spread.sortWithinPartitions(F.desc("length"), "_id", "piece", "ids_crc32")
    packed = placed(ordered, capacity, most_open).unionByName(full)
    return packed.withColumnRenamed("_id", id_col)
