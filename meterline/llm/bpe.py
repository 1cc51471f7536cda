"""Byte-pair encoding as a streaming transducer, and its way back to text.

A merge can change the tokens before it only through a chain of merges of rising rank, each
taking the left part of the one before, or the token it made, as its right part. The longest such chain, counted in
symbols, is the lookahead: whatever follows, tokens that end so far before the end of what
has been read are final. So a piece of any length is encoded in a buffer of fixed size.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from meterline.llm.columns import by_slices, hidden, in_batches, keeps, shown

CHUNK_CHARS = 1 << 16  # of a text at once
BUFFER_SYMBOLS = 1 << 12  # of a long piece at once
CACHED_PIECES = 1 << 18  # and at most as many older ones, about 140 MB of a worker in all
LONGEST_CACHED = 48
ALL = sys.maxunicode + 1
NEVER = 1 << 30  # the rank of a pair that no merge joins

# Fixed values of the word vocabulary's format: white space, its pattern of pieces, and the
# endings that are pieces of their own.
SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Letters, numbers and lower cases of Unicode 16 and 17 that Python's own tables lack.
LATER = {
    "L": [
        (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3),
        (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389),
        (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
        (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
        (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
        (0x1E5F0, 0x1E5F0),
    ],
    "N": [
        (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139),
        (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
    ],
}
LATER_LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3,
    0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
    **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
ASCII_PIECES = re.compile(ENDINGS + r"|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
BLANK = re.compile(r"[\t-\r ]")


@cache
def pieces_pattern(characters: int = ALL) -> re.Pattern:
    """Endings, runs of letters, single digits, runs of anything else but white space.

    For texts of the first ``characters`` only; a pattern of few characters is faster.
    """
    kinds = [unicodedata.category(chr(i))[0] for i in range(characters)]
    classes = {kind: "" for kind in "LN"}
    start = 0
    for end in range(1, len(kinds) + 1):
        if end == len(kinds) or kinds[end] != kinds[start]:
            if kinds[start] in classes:
                classes[kinds[start]] += f"\\U{start:08x}-\\U{end - 1:08x}"
            start = end
    for kind, ranges in LATER.items():
        classes[kind] += "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges if a < characters)
    letter, number = classes["L"], classes["N"]
    space = "".join(map(chr, SPACE))
    return re.compile(f"{ENDINGS}|[{letter}]+|[{number}]|[^{space}{letter}{number}]+")


def is_latin(text: str) -> bool:
    try:
        return bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and added tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        model = stored["model"]
        kinds = [n["type"] for n in (stored["normalizer"] or {}).get("normalizers", [])]
        if (
            model["type"] != "BPE"
            or kinds != ["NFC", "Replace", "Lowercase"]
            or stored["post_processor"]
            or stored["decoder"]
        ):
            raise ValueError("only lower-case byte-pair vocabularies with word ends are known")
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.added = {t["content"]: t["id"] for t in stored["added_tokens"]}
        self.names = [""] * (1 + max([*self.ids.values(), *self.added.values()]))
        for name, number in (self.ids | self.added).items():
            self.names[number] = name
        characters = byte_characters()
        self.inner = [self.ids[c] for c in characters]
        self.last = [self.ids[c + self.suffix] for c in characters]
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: list[int] = []  # the new token of each rank
        known = {*self.inner, *self.last}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            key, new = (self.ids[left], self.ids[right]), self.ids[left + right]
            if not known.issuperset(key):
                raise ValueError(f"merge {rank} uses a token that no earlier merge makes")
            self.ranks[key] = rank
            self.made.append(new)
            known.add(new)
        self.lookahead = self.sufficient_lookahead()
        self.special = re.compile("|".join(map(re.escape, sorted(self.added, key=len)))) if self.added else None

    def symbols(self, token: int) -> int:
        """Bytes that a token stands for."""
        return len(self.names[token].removesuffix(self.suffix) or self.names[token])

    def sufficient_lookahead(self) -> int:
        """The most symbols before the end of known text whose tokens the rest may change.

        The merges are taken from the last to the first. ``reach[t]`` is the longest chain of
        later merges that begins with one whose right part is t; a merge that takes away or
        gives back its left part continues such a chain, and so does one that makes its token.
        """
        reach: dict[int, int] = {}
        longest = 1
        for (left, right), rank in sorted(self.ranks.items(), key=lambda m: -m[1]):
            chain = self.symbols(left) + max(reach.get(left, 0), reach.get(self.made[rank], 0))
            longest = max(longest, chain)
            reach[right] = max(reach.get(right, 0), chain)
        return longest

    def merge(self, tokens: list[int]) -> list[int]:
        """Apply the merges by rank, equal ones from left to right."""
        if len(tokens) > LONGEST_CACHED:
            return self.merge_long(tokens)
        rank, made, tokens = self.ranks.get, self.made, list(tokens)
        ranks = [rank(pair, NEVER) for pair in zip(tokens, tokens[1:])]
        while ranks and (least := min(ranks)) != NEVER:
            i = ranks.index(least)
            new = tokens[i] = made[least]
            del tokens[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank((tokens[i - 1], new), NEVER)
            if i < len(ranks):
                ranks[i] = rank((new, tokens[i + 1]), NEVER)
        return tokens

    def merge_long(self, tokens: list[int]) -> list[int]:
        """The same with a heap and a linked list."""
        tokens, n = list(tokens), len(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, heap = self.ranks.get, []
        for i, pair in enumerate(zip(tokens, tokens[1:])):
            if (found := rank(pair)) is not None:
                heap.append((found, i, *pair))
        heapq.heapify(heap)
        while heap:
            least, i, left, right = heapq.heappop(heap)
            j = after[i]
            if tokens[i] != left or j >= n or tokens[j] != right:
                continue
            new = tokens[i] = self.made[least]
            tokens[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (found := rank((new, tokens[k]))) is not None:
                    heapq.heappush(heap, (found, i, new, tokens[k]))
            if (h := before[i]) >= 0 and (found := rank((tokens[h], new))) is not None:
                heapq.heappush(heap, (found, h, tokens[h], new))
        return [t for t in tokens if t >= 0]


class PieceTransducer:
    """Tokens of one piece whose bytes arrive bit by bit; it holds a buffer of fixed size."""

    def __init__(self, vocabulary: Vocabulary, buffer: int = BUFFER_SYMBOLS):
        self.vocabulary = vocabulary
        self.buffer = max(buffer, 2 * vocabulary.lookahead)
        self.held: list[int] = []  # bytes whose tokens are not final

    def feed(self, data: bytes) -> Iterator[int]:
        for at in range(0, len(data), self.buffer):
            self.held.extend(data[at : at + self.buffer])
            if len(self.held) > self.buffer:
                yield from self.stable()

    def stable(self) -> Iterator[int]:
        """Tokens that end at least the lookahead before the last known byte."""
        inner = self.vocabulary.inner
        # The last byte may yet turn out to end the piece, which makes it another symbol.
        tokens = self.vocabulary.merge([inner[b] for b in self.held[:-1]])
        final, end = len(self.held) - 1 - self.vocabulary.lookahead, 0
        for token in tokens:
            size = self.vocabulary.symbols(token)
            if end + size > final:
                break
            end += size
            yield token
        del self.held[:end]

    def finish(self) -> list[int]:
        if not self.held:
            return []
        inner, last = self.vocabulary.inner, self.vocabulary.last
        tokens = self.vocabulary.merge([*(inner[b] for b in self.held[:-1]), last[self.held[-1]]])
        self.held = []
        return tokens


class Encoder:
    """Text to the ids of a vocabulary, as bytes of little-endian unsigned 32-bit numbers."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # what comes again goes back to the cache

    def piece(self, piece: str) -> bytes:
        found = self.cache.get(piece)
        if found is None:
            found = self.older.get(piece)
            if found is None:
                data = piece.encode()
                if len(data) > LONGEST_CACHED:
                    transducer = PieceTransducer(self.vocabulary)
                    return array("I", [*transducer.feed(data), *transducer.finish()]).tobytes()
                inner, last = self.vocabulary.inner, self.vocabulary.last
                ids = self.vocabulary.merge([*[inner[b] for b in data[:-1]], last[data[-1]]])
                found = array("I", ids).tobytes()
            if len(self.cache) >= CACHED_PIECES:
                self.older, self.cache = self.cache, {}
            self.cache[piece] = found
        return found

    def plain(self, text: str) -> bytes:
        """The ids of a text without added tokens."""
        if text.isascii():
            pieces = ASCII_PIECES.findall(text.lower())
        else:
            # Letter by letter, so a final sigma is none.
            lowered = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
            if is_latin(lowered):
                pieces = pieces_pattern(256).findall(lowered)
            else:
                pieces = pieces_pattern().findall(lowered.translate(LATER_LOWER))
        found = list(map(self.cache.get, pieces))
        if None in found:
            found = [self.piece(p) if f is None else f for p, f in zip(pieces, found, strict=True)]
        return b"".join(found)

    def stream(self, text: str) -> Iterator[bytes]:
        """The ids of a text, block by block; blocks of text end before a blank."""
        special, start = self.vocabulary.special, 0
        while start < len(text):
            end = len(text)
            if start + CHUNK_CHARS < end and (blank := BLANK.search(text, start + CHUNK_CHARS)):
                end = blank.start()
            at = start
            for match in special.finditer(text, start, end) if special and "<|" in text else ():
                yield self.plain(text[at : match.start()])
                yield self.vocabulary.added[match[0]].to_bytes(4, "little")
                at = match.end()
            yield self.plain(text[at:end])
            start = end


class Utf8Reader:
    """An incremental state machine from bytes to text.

    Its state is the bytes of one unfinished character, at most three. Bytes that fit no
    character become the replacement character, one for each longest wrong start.
    """

    # Fixed values of UTF-8: for each first byte the number of bytes that follow and the
    # range of the second.
    FIRST = (
        [(0, 0, 0)] * 0x80 + [None] * 0x42 + [(1, 0x80, 0xBF)] * 0x1E + [(2, 0xA0, 0xBF)]
        + [(2, 0x80, 0xBF)] * 12 + [(2, 0x80, 0x9F)] + [(2, 0x80, 0xBF)] * 2 + [(3, 0x90, 0xBF)]
        + [(3, 0x80, 0xBF)] * 3 + [(3, 0x80, 0x8F)] + [None] * 11
    )

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes) -> str:
        data, self.held = self.held + data, b""
        try:
            return data.decode()
        except UnicodeDecodeError as wrong:
            out, i, n = [data[: wrong.start].decode()], wrong.start, len(data)
        while i < n:
            kind = self.FIRST[data[i]]
            if kind is None:
                out.append("�")
                i += 1
                continue
            follow, low, high = kind
            j = i + 1
            while j < n and j <= i + follow and low <= data[j] <= high:
                j, low, high = j + 1, 0x80, 0xBF
            if j == i + follow + 1:
                out.append(data[i:j].decode())
            elif j == n:
                self.held = data[i:]
                break
            else:
                out.append("�")
            i = j
        return "".join(out)

    def finish(self) -> str:
        rest, self.held = self.held, b""
        return "�" if rest else ""


class Decoder:
    """Ids to text, block by block.

    ``words=False`` gives the names of the tokens with a blank between them, as a vocabulary
    file without a decoder asks for. ``words=True`` gives the bytes they stand for, with a
    blank for each word end.
    """

    def __init__(self, vocabulary: Vocabulary, words: bool = False):
        self.reader, self.words, self.first = Utf8Reader(), words, True
        self.table = [name.encode() for name in vocabulary.names]
        if words:
            to_byte = {c: b for b, c in enumerate(byte_characters())}
            end = vocabulary.suffix
            for name, number in vocabulary.ids.items():
                whole = end and name.endswith(end) and name != end
                text = name.removesuffix(end) if whole else name
                self.table[number] = bytes(to_byte[c] for c in text) + b" " * bool(whole)

    def restart(self) -> None:
        self.reader, self.first = Utf8Reader(), True

    def surface(self, ids: bytes) -> bytes:
        """The bytes of some ids; they are cut within a character only if words are wanted."""
        parts = map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist())
        if self.words:
            return b"".join(parts)
        joined = b" ".join(parts)
        if ids and not self.first:
            joined = b" " + joined
        self.first = self.first and not ids
        return joined

    def feed(self, ids: bytes) -> str:
        return self.reader.feed(self.surface(ids))

    def finish(self) -> str:
        return self.reader.finish()


_ENCODERS: dict[str, Encoder] = {}
keeps(_ENCODERS)


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, read once by each worker for an operator's tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(Vocabulary(path))
    return _ENCODERS[path]


def per_text(docs: DataFrame, text_col: str, results: list[T.StructField], work) -> DataFrame:
    """``docs`` with ``results``, which ``work`` makes from each whole text (null: empty)."""
    source, names = hidden(docs)
    column = next(k for k, name in names.items() if name == text_col)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = None
        for batch in by_slices(batches, column):
            made = [work(text or "") for text in batch.column(column).to_pylist()]
            made = zip(*made, strict=True) if made else [[] for _ in results]
            kinds = kinds or [to_arrow_type(f.dataType) for f in results]
            arrays = [pa.array(list(m), k) for m, k in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *arrays], [*batch.schema.names, *(f.name for f in results)]
            )

    schema = T.StructType([*source.schema.fields, *results])
    return shown(in_batches(source, compute, schema), names, *(f.name for f in results))


def encode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the tokens of each whole text; null and empty texts have none."""

    def work(text: str) -> tuple:
        return (np.frombuffer(b"".join(encoder(path).stream(text)), "<u4").tolist(),)

    return per_text(docs, text_col, [T.StructField("ids", T.ArrayType(T.LongType()))], work)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", words: bool = True) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ids; a null list gives an empty text."""
    source, names = hidden(encoded)
    column = next(k for k, name in names.items() if name == ids_col)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(encoder(path).vocabulary, words)
        for batch in batches:
            texts = []
            for ids in batch.column(column).to_pylist():
                decoder.restart()
                block = np.array(ids or [], dtype="<u4").tobytes()
                texts.append(decoder.feed(block) + decoder.finish())
            yield batch.append_column("decoded", pa.array(texts, pa.string()))

    schema = T.StructType([*source.schema.fields, T.StructField("decoded", T.StringType())])
    return shown(in_batches(source, compute, schema), names, "decoded")


def token_digests(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256 of each whole text.

    The ids are hashed as little-endian unsigned 32-bit numbers, the decoded text, names of
    the tokens with blanks between, in UTF-8. Both are hashed block by block, so a long text
    takes no more memory than its own. A null text counts as empty, which has no token.
    """
    decoders: dict[str, Decoder] = {}

    def work(text: str) -> tuple:
        tool = encoder(path)
        decoder = decoders.get(path) or decoders.setdefault(path, Decoder(tool.vocabulary))
        decoder.restart()
        n, ids, decoded = 0, sha256(), sha256()
        for block in tool.stream(text):
            n += len(block) // 4
            ids.update(block)
            decoded.update(decoder.feed(block).encode())
        decoded.update(decoder.finish().encode())
        return n, ids.hexdigest(), decoded.hexdigest()

    results = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    return per_text(docs, text_col, results, work)
