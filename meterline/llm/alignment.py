"""Alignment of the tokens that two vocabularies make of one text.

Each batch becomes two tables of tokens with the byte at which each begins. An as-of merge by
document gives every token of one side the token of the other that covers its first byte; the
pairs of both directions together are all overlaps, as of two overlapping tokens one begins
inside the other. Where tokens of both sides end at one byte, a group ends.

How often two tokens overlap is counted over the whole corpus, and each document is then
judged by these counts. Frequent pairs are sent to every task, as many as a fixed bound
allows; the rare rest is joined, so no pair of many documents is ever shuffled.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import cached_property
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.bpe import byte_characters
from meterline.llm.columns import by_slices, in_batches
from meterline.session import cut_lineage

SLICE_BYTES = 1 << 20
UNIT_CHARS = 1 << 16  # of a long text at once
LONG_RUN = 1000  # bytes of one class
MOST_PAIRS = 1 << 20  # that every task may hold
PENDING_PAIRS = 1 << 21

# Fixed value: how the byte-level vocabulary cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: the model's normalizer message with add_dummy_prefix off, to be merged into it.
NO_PREFIX = b"\x1a\x02\x18\x00"
BLANK = "▁"

# Both vocabularies begin a token anew at a single blank between other characters, and the
# byte-level one also where a letter or number follows one of these signs.
CUT = re.compile(r"(?<=\S)(?= \S)|(?<=[!-&(-/:-@\[-`{-~。，、；：？！])(?=[^\W_])")


class TokenBytes:
    """The bytes of every token of a vocabulary, end to end."""

    def __init__(self, tokens: dict[int, bytes]):
        self.count = 1 + max(tokens)
        parts = [tokens.get(i, b"") for i in range(self.count)]
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(parts), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ids) else 0)]


class Tools:
    """Both vocabularies, read from what the driver found in their files."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        import sentencepiece
        import tiktoken

        self.stored = byte_level
        model = json.loads(byte_level)["model"]
        to_byte = {c: b for b, c in enumerate(byte_characters())}
        ranks = {bytes(to_byte[c] for c in name): i for name, i in model["vocab"].items()}
        order = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        if any(model["vocab"][a] >= model["vocab"][b] for a, b in zip(order, order[1:])):
            raise ValueError("only byte-level vocabularies numbered in the order of their merges are known")
        self.a = TokenBytes({i: name for name, i in ranks.items()})
        self.fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=pieces + NO_PREFIX)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        coded = re.compile("<0x([0-9A-F]{2})>")
        self.b = TokenBytes(
            {
                i: bytes([int(found[1], 16)]) if (found := coded.fullmatch(n)) else n.replace(BLANK, " ").encode()
                for i, n in enumerate(names)
            }
        )
        self.adjacent = {n[k : k + 2] for n in names for k in range(len(n) - 1)}
        self.classes = np.full(256, 3, np.uint8)
        self.classes[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 0
        self.classes[48:58] = 1
        self.classes[[*range(9, 14), *range(28, 33)]] = 2

    @cached_property
    def slow(self):
        """For very long runs of letters, where the other's time grows with the square."""
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(self.stored.decode())
        tokenizer.encode_special_tokens = True
        return tokenizer

    def byte_level_ids(self, text: str, data: bytes) -> np.ndarray:
        classes = self.classes[np.frombuffer(data, np.uint8)]
        edges = np.flatnonzero(np.diff(classes, prepend=9, append=9))
        if np.diff(edges).max() > LONG_RUN:
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.int64)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)

    def units(self, text: str | None) -> list[str]:
        """A blank and the text, cut where no token of either side goes across."""
        if not text:
            return []
        text, at, found = " " + text, 0, []
        while len(text) - at > UNIT_CHARS:
            for cut in CUT.finditer(text, at + UNIT_CHARS):
                place = cut.start()
                if text[place - 1 : place + 1].replace(" ", BLANK) not in self.adjacent:
                    break
            else:
                break
            found.append(text[at:place])
            at = place
        return [*found, text[at:]]


_TOOLS: dict[tuple[bytes, bytes], Tools] = {}


def tools_of(files: tuple[bytes, bytes]) -> Tools:
    if files not in _TOOLS:
        _TOOLS[files] = Tools(*files)
    return _TOOLS[files]


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """All pairs of overlapping tokens, as their numbers a and b.

    Both tables have doc, at (the first byte, rising over all documents) and their number;
    the tokens of a document cover the same bytes in both.
    """
    under_a = pd.merge_asof(a, b.assign(same=b["at"]), on="at", by="doc")
    under_b = pd.merge_asof(b, a.assign(same=a["at"]), on="at", by="doc")
    under_b = under_b[under_b["same"] != under_b["at"]]  # tokens that begin together are found already
    return pd.concat([under_a[["a", "b"]], under_b[["a", "b"]]], ignore_index=True)


class Aligned:
    """Tokens of some units of text: links and groups, with the unit of each."""

    def __init__(self, tools: Tools, a: list[np.ndarray], b: list[np.ndarray]):
        self.ids = np.concatenate(a), np.concatenate(b)
        sizes = tools.a.sizes[self.ids[0]], tools.b.sizes[self.ids[1]]
        ends = np.cumsum(sizes[0]), np.cumsum(sizes[1])
        self.counts = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        units = np.arange(len(a))
        sides = [
            pd.DataFrame({"at": end - size, "doc": np.repeat(units, n), name: np.arange(len(end))})
            for name, end, size, n in zip("ab", ends, sizes, self.counts, strict=True)
        ]
        links = overlaps(*sides)
        first, second = links["a"].to_numpy(), links["b"].to_numpy()
        self.pairs = self.ids[0][first] * tools.b.count + self.ids[1][second]
        self.pair_units = sides[0]["doc"].to_numpy()[first]
        # A token is the last of its group if one of the other side ends with it.
        self.last_a = ends[1][np.searchsorted(ends[1], ends[0])] == ends[0]
        self.last_b = ends[0][np.searchsorted(ends[0], ends[1])] == ends[1]
        self.groups = np.bincount(sides[0]["doc"].to_numpy()[self.last_a], minlength=len(a))

    def written(self) -> list[memoryview]:
        """Each unit's groups as text: ids of one side, a bar, ids of the other, a semicolon."""
        a, b = self.ids
        group_a = np.cumsum(self.last_a) - self.last_a
        group_b = np.cumsum(self.last_b) - self.last_b
        before = np.concatenate([[0], np.flatnonzero(self.last_b) + 1])[group_a]
        until = (np.flatnonzero(self.last_a) + 1)[group_b]
        n = len(a) + len(b)
        ids, signs = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
        at_a, at_b = np.arange(len(a)) + before, np.arange(len(b)) + until
        ids[at_a], ids[at_b] = a, b
        signs[at_a[self.last_a]], signs[at_b[self.last_b]] = ord("|"), ord(";")
        width = len(str(int(ids.max())))
        shown = np.empty((n, width + 1), np.uint8)
        rest = ids
        used = np.empty((n, width + 1), bool)
        for column in range(width - 1, -1, -1):
            used[:, column] = (rest > 0) | (column == width - 1)
            rest, digit = np.divmod(rest, 10)
            shown[:, column] = digit + 48
        shown[:, width], used[:, width] = signs, True
        edges = np.concatenate([[0], np.cumsum(used.sum(axis=1))])
        flat = memoryview(shown[used])
        ends = np.cumsum(self.counts[0] + self.counts[1])
        return [flat[edges[e - k] : edges[e]] for e, k in zip(ends, self.counts[0] + self.counts[1], strict=True)]


class BatchOfRows:
    """What the units of some rows add up to."""

    def __init__(self, rows: int, tools: Tools):
        self.tools, self.sums = tools, np.zeros((4, rows), np.int64)
        self.digests = [sha256() for _ in range(rows)]
        self.wrong = np.zeros(rows, bool)
        self.pairs: list[np.ndarray] = []
        self.rows: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.held: list[bytes] = [b""] * rows

    def add(self, units: list[tuple[int, str]]) -> None:
        units = [unit for unit in units if not self.wrong[unit[0]]]
        data = [text.encode() for _, text in units]
        a = [self.tools.byte_level_ids(text, d) for (_, text), d in zip(units, data, strict=True)]
        b = [np.array(ids, np.int64) for ids in self.tools.pieces.encode([t for _, t in units], num_threads=1)]
        good = []
        for i, d in enumerate(data):
            fits = self.tools.a.sizes[a[i]].sum() == self.tools.b.sizes[b[i]].sum() == len(d)
            whole = np.frombuffer(d, np.uint8)
            fits = fits and np.array_equal(self.tools.a.joined(a[i]), whole)
            if fits and np.array_equal(self.tools.b.joined(b[i]), whole):
                good.append(i)
            else:
                self.wrong[units[i][0]] = True
        if not good:
            return
        row = np.array([units[i][0] for i in good])
        found = Aligned(self.tools, [a[i] for i in good], [b[i] for i in good])
        links = np.bincount(found.pair_units, minlength=len(good))
        for k, values in enumerate([*found.counts, found.groups, links]):
            np.add.at(self.sums[k], row, values)
        for r, part in zip(row.tolist(), found.written(), strict=True):
            # A semicolon stands between groups, so the last one waits for what follows.
            self.digests[r].update(self.held[r])
            self.digests[r].update(part[:-1])
            self.held[r] = b";"
        self.keep(row[found.pair_units], found.pairs, np.ones(len(found.pairs), np.int64))

    def keep(self, rows: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> None:
        """Add pairs, and join equal ones of a row once there are many."""
        for kept, new in ((self.rows, rows), (self.pairs, pairs), (self.times, times)):
            kept.append(new)
        if len(self.rows) > 8:
            joined = self.distinct()
            self.rows, self.pairs, self.times = ([part] for part in joined)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.rows:
            return (np.zeros(0, np.int64),) * 3
        size = self.tools.a.count * self.tools.b.count
        keys = np.concatenate(self.rows) * size + np.concatenate(self.pairs)
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], np.concatenate(self.times)[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[first] // size, keys[first] % size, np.add.reduceat(times, first) if len(first) else times

    def columns(self) -> list[pa.Array]:
        """n_a, n_b, n_groups, n_links, groups_sha256, and the distinct pairs of each row."""
        rows, pairs, times = self.distinct()
        right = ~self.wrong[rows]
        rows, pairs, times = rows[right], pairs[right], times[right]
        self.sums[:, self.wrong] = 0
        edges = pa.array(np.searchsorted(rows, np.arange(len(self.wrong) + 1)), pa.int32())
        shown = ["" if not n else d.hexdigest() for n, d in zip(self.sums[0], self.digests, strict=True)]
        return [
            *(pa.array(s, pa.int64()) for s in self.sums),
            pa.array(shown, pa.string()),
            pa.ListArray.from_arrays(edges, pa.array(pairs, pa.int64())),
            pa.ListArray.from_arrays(edges, pa.array(times, pa.int32())),
        ]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times")


def align(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's tokens, groups and links: the id, n_a, n_b, n_groups, n_links,
    groups_sha256, and its distinct linked pairs of ids with how many links have each.

    A pair is the first side's id times the size of the second vocabulary, plus the second
    side's id. The files are read by the driver and sent along. Texts that are null, empty
    or not given back whole by both sides have no tokens. Long texts are aligned in parts
    cut where no token goes across; a text without a blank or sign is one part.
    """
    files = tuple(open(path, "rb").read() for path in (byte_level, pieces))
    shared = docs.sparkSession.sparkContext.broadcast(files)
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_slices(batches, "_text", SLICE_BYTES):
            tools = tools_of(shared.value)
            rows, waiting, size = BatchOfRows(batch.num_rows, tools), [], 0
            for i, text in enumerate(batch.column("_text").to_pylist()):
                for unit in tools.units(text):
                    waiting.append((i, unit))
                    size += len(unit)
                    if size > SLICE_BYTES:
                        rows.add(waiting)
                        waiting, size = [], 0
            if waiting:
                rows.add(waiting)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *rows.columns()], ["_id", *COLUMNS])

    schema = (
        f"_id {source.schema['_id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, "
        "n_links long, groups_sha256 string, pairs array<long>, times array<int>"
    )
    return in_batches(source, compute, schema).withColumnRenamed("_id", id_col)


def flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs and times of all rows in one, and where each row begins."""
    pairs, times = batch.column("pairs"), batch.column("times")
    sizes = np.array(pairs.value_lengths().fill_null(0))
    return np.array(pairs.flatten()), np.array(times.flatten(), np.int64), np.concatenate([[0], np.cumsum(sizes)])


def pair_counts(aligned: DataFrame, second_size: int) -> DataFrame:
    """A written table of every pair of the corpus: pair, n (its links), and best, whether no
    pair of the same second token has more. Tasks add up what they read before the shuffle.
    """

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            keys, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, place, np.concatenate([n for _, n in held]))
            return keys, sums

        for batch in batches:
            pairs, times, _ = flat(batch)
            held.append((pairs, times))
            waiting += len(pairs)
            if waiting > PENDING_PAIRS:
                held = [summed()]
                waiting = 0
                if len(held[0][0]) > PENDING_PAIRS:  # too many to keep
                    yield pa.record_batch(dict(zip(("pair", "n"), map(pa.array, held[0]), strict=True)))
                    held = []
        if held:
            yield pa.record_batch(dict(zip(("pair", "n"), map(pa.array, summed()), strict=True)))

    partial = in_batches(aligned.select("pairs", "times"), add_up, "pair long, n long")
    counts = cut_lineage(partial.groupBy("pair").agg(F.sum("n").alias("n")))
    second = F.col("pair") % second_size
    # One row for each token of the second vocabulary.
    highest = counts.groupBy(second.alias("_second")).agg(F.max("n").alias("_most"))
    judged = counts.join(F.broadcast(highest), second == F.col("_second"))
    return cut_lineage(judged.select("pair", "n", (F.col("n") == F.col("_most")).alias("best")))


def frequent_from(counts: DataFrame, most_pairs: int) -> int:
    """The least count such that at most ``most_pairs`` pairs have it or a higher one."""
    # Eight steps for each doubling: some five hundred rows at most.
    step = F.floor(8 * F.log2("n")).cast("int").alias("step")
    sizes = counts.groupBy(step).agg(F.count("*").alias("pairs"), F.min("n").alias("least")).collect()
    kept, least = 0, 1 << 62
    for row in sorted(sizes, key=lambda r: -r.step):
        kept += row.pairs
        if kept > most_pairs:
            break
        least = row.least
    return least


def judge(aligned: DataFrame, counts: DataFrame, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """``aligned`` (a written table) with n_best and count_sum instead of its pairs."""
    numbered = cut_lineage(aligned.withColumn("_row", F.monotonically_increasing_id()))
    least = frequent_from(counts, most_pairs)
    known = counts.filter(F.col("n") >= least).toArrow().sort_by("pair")
    shared = counts.sparkSession.sparkContext.broadcast(
        tuple(known.column(name).to_numpy() for name in ("pair", "n", "best"))
    )
    kept = [name for name in numbered.columns if name not in ("pairs", "times")]

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = shared.value
        for batch in batches:
            pairs, times, edges = flat(batch)
            place = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
            hit = keys[place] == pairs if len(keys) else np.zeros(len(pairs), bool)
            count = np.where(hit, n[place], 0) * times if len(keys) else np.zeros(len(pairs), np.int64)
            is_best = np.where(hit & best[place], times, 0) if len(keys) else count
            sums = [np.diff(np.concatenate([[0], np.cumsum(v)])[edges]) for v in (is_best, count)]
            rare = np.concatenate([[0], np.cumsum(~hit)])[edges].astype(np.int32)
            rest = [pa.ListArray.from_arrays(rare, pa.array(v[~hit], k)) for v, k in ((pairs, pa.int64()), (times, pa.int32()))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in kept), *(pa.array(s, pa.int64()) for s in sums), *rest],
                [*kept, "n_best", "count_sum", "pairs", "times"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema if f.name in kept)
    schema = f"{kinds}, n_best long, count_sum long, pairs array<long>, times array<int>"
    judged = in_batches(numbered, compute, schema)
    if counts.filter(F.col("n") < least).isEmpty():
        return judged.drop("_row", "pairs", "times")
    judged = cut_lineage(judged)
    rare = judged.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("_of"))
    rare = rare.select("_row", F.col("_of.pairs").alias("pair"), F.col("_of.times").alias("_times"))
    found = rare.join(counts.filter(F.col("n") < least), "pair")
    more = found.groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("_times")).otherwise(0)).alias("_best"),
        F.sum(F.col("n") * F.col("_times")).alias("_sum"),
    )
    whole = judged.drop("pairs", "times").join(more, "_row", "left")
    added = {"n_best": "_best", "count_sum": "_sum"}
    return whole.withColumns({name: F.col(name) + F.coalesce(extra, F.lit(0)) for name, extra in added.items()}).drop(
        "_row", "_best", "_sum"
    )


def cross_tokenizer(
    docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text",
    most_pairs: int = MOST_PAIRS,
) -> DataFrame:
    """One row for each document: id, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256.

    ``byte_level`` is the first vocabulary's file, ``pieces`` the second's. A link counts for
    n_best if no pair of its second token has more links in the corpus; count_sum adds the
    corpus' counts of all links. Texts without tokens (see ``align``) have zeros and an empty
    digest. Repeated rows are documents each and null ids stay; an empty table gives an empty
    result; other columns are not read. The tokenizers run once, the pairs are kept between.
    """
    aligned = cut_lineage(align(docs, byte_level, pieces, id_col, text_col))
    second = tools_of(tuple(open(path, "rb").read() for path in (byte_level, pieces))).b.count
    judged = judge(aligned, pair_counts(aligned, second), most_pairs)
    return judged.select(id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
