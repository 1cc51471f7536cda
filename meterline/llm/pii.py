"""Personal data by fixed patterns and by a character tagger.

What the patterns find is always reported. A bidirectional LSTM with a random field, trained
on labelled spans, reads the text in overlapping windows; of two windows the one whose middle
is nearer decides, so the tags of all windows make one sequence for the whole text. Spans of
that sequence that hold what their kind must, and overlap nothing found by patterns, are added.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from meterline.llm import char_tagger
from meterline.llm.char_tagger import Tagger
from meterline.llm.columns import by_slices, hidden, in_batches, shown

KINDS = ("email", "ip", "card", "phone")

# The patterns of the base kinds. Digits and letters are ASCII. A run of digits
# is taken whole, so it is tried from its start only.
LOCAL = "A-Za-z0-9._%+-"
LOCAL_END = re.compile(f"[{LOCAL}]*+$")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)

# The tagger reads letters as small, large or other, digits as one, and these as themselves.
SIGNS = "@._%+-()[]{}<>:/\\,;'\"=&#*$!?|~ \t\n"
PAD, DIGIT, SMALL, LARGE, OTHER_LETTER, OTHER = range(6)
SYMBOLS = 6 + len(SIGNS)
TELLING = np.zeros(SYMBOLS, bool)
TELLING[[DIGIT, *(6 + SIGNS.index(sign) for sign in "@([")]] = True
BLANK = np.zeros(SYMBOLS, bool)
BLANK[[6 + SIGNS.index(sign) for sign in " \t\n"]] = True
WINDOW, STRIDE = 128, 64
WINDOWS_AT_ONCE = 2048

# Training reads at most about so many rows, of at most so many characters each, and makes at
# most so many windows of each sort.
SAMPLE_ROWS = 4000
SAMPLE_CHARS = 20_000
SAMPLE_WINDOWS = 1500
MOST_REPEATS = 8
TRAINING_WINDOW = 64

SPAN = T.StructType(
    [
        T.StructField("start", T.IntegerType()),
        T.StructField("order", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("base", T.BooleanType()),
    ]
)
Span = tuple[int, int, int]  # start, kind, end


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def passes_luhn(number: str) -> bool:
    odd = sum(map(int, number[-1::-2]))
    even = sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in number[-2::-2])
    return (odd + even) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each at-sign: the run of local characters before it, back to the last match."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
            at = text.find("@", end)
        else:
            at = text.find("@", at + 1)


def is_ip(text: str) -> bool:
    """Whether all parts are at most 255; they may have any number of zeros in front."""
    parts = [part.lstrip("0") for part in text.split(".")]
    return all(len(part) < 3 or (len(part) == 3 and part <= "255") for part in parts)


def is_card(text: str) -> bool:
    number = digits(text)
    return CARD_DIGITS[0] <= len(number) <= CARD_DIGITS[1] and passes_luhn(number)


def is_phone(text: str) -> bool:
    return PHONE_DIGITS[0] <= len(digits(text)) <= PHONE_DIGITS[1]


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by start, then kind; leftmost first, without overlap in a kind."""
    found: list[Span] = [(a, 0, b) for a, b in emails(text)]
    for kind, pattern, holds in ((1, IP, is_ip), (2, CARD, is_card), (3, PHONE, is_phone)):
        if kind == 3 and "+" not in text:
            continue
        found += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if holds(m[0])]
    return sorted(found)


@cache
def classes() -> np.ndarray:
    """The symbol of each code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    table[[i for i in range(128, 0x110000) if chr(i).isalpha()]] = OTHER_LETTER
    table[ord("0") : ord("9") + 1] = DIGIT
    table[ord("a") : ord("z") + 1] = SMALL
    table[ord("A") : ord("Z") + 1] = LARGE
    for i, sign in enumerate(SIGNS):
        table[ord(sign)] = 6 + i
    return table


def symbols(text: str) -> np.ndarray:
    return classes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]


def windows_of(marks: np.ndarray) -> np.ndarray:
    """Windows of one length, each starting a stride after the last; the end is padded."""
    n = max(1, -(-(len(marks) - (WINDOW - STRIDE)) // STRIDE))
    padded = np.zeros((n - 1) * STRIDE + WINDOW, np.uint8)
    padded[: len(marks)] = marks[: len(padded)]
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE]


def reconciled(tags: np.ndarray, length: int) -> np.ndarray:
    """One tag for each character: from the window in which it is nearest to the middle."""
    edge = (WINDOW - STRIDE) // 2
    whole = np.zeros((len(tags) - 1) * STRIDE + WINDOW, np.int8)
    whole[: WINDOW - edge] = tags[0, : WINDOW - edge]
    for i in range(1, len(tags)):
        last = WINDOW if i == len(tags) - 1 else WINDOW - edge
        whole[i * STRIDE + edge : i * STRIDE + last] = tags[i, edge:last]
    if len(tags) > 1 or length > WINDOW - edge:
        whole[(len(tags) - 1) * STRIDE + WINDOW - edge :] = tags[-1, WINDOW - edge :]
    return whole[:length]


def near_signs(marks: np.ndarray) -> np.ndarray:
    """The characters of words with a digit, an at-sign or an opening bracket, and of the words
    beside them. All spans that hold personal data of these kinds lie within such words."""
    blank = BLANK[marks]
    word = np.cumsum(np.diff(blank, prepend=True) & ~blank)  # from 1; a blank has the word's before
    telling = np.zeros(word[-1] + 3, bool)
    telling[word[TELLING[marks]]] = True
    telling[1:-1] |= telling[:-2] | telling[2:]
    return telling[word] & ~blank


def tagged(marks: list[np.ndarray], tagger: Tagger) -> list[np.ndarray]:
    """The tags of each text. Only windows that reach into words near a telling sign are
    decoded; the tags of others could not become a span."""
    cut = [windows_of(m) for m in marks]
    live = [windows_of(near_signs(m)).any(axis=1) if len(m) else np.zeros(len(c), bool) for m, c in zip(marks, cut, strict=True)]
    tags = [np.zeros(w.shape, np.int8) for w in cut]
    places = [(i, j) for i, alive in enumerate(live) for j in np.flatnonzero(alive)]
    for at in range(0, len(places), WINDOWS_AT_ONCE):
        some = places[at : at + WINDOWS_AT_ONCE]
        decoded = tagger.decode(np.stack([cut[i][j] for i, j in some]))
        for (i, j), found in zip(some, decoded, strict=True):
            tags[i][j] = found
    return [reconciled(t, len(m)) if len(m) else np.zeros(0, np.int8) for t, m in zip(tags, marks, strict=True)]


def added_spans(text: str, tags: np.ndarray, base: list[Span]) -> list[Span]:
    """Runs of one tag that hold what their kind must and overlap no base span."""
    if not tags.any():
        return []
    edges = np.flatnonzero(np.diff(tags, prepend=0, append=0))
    found = []
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        kind = int(tags[start]) - 1
        if kind < 0:
            continue
        while start < end and not is_edge(text[start]):
            start += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        span = text[start:end]
        if not holds(kind, span):
            continue
        outside = text[start - 1 : start] + text[end : end + 1]
        if any(c.isalnum() for c in outside):
            continue
        if not any(a < end and start < b for a, _, b in base):
            found.append((start, kind, end))
    return found


def is_edge(character: str) -> bool:
    return character.isalnum() or character in "+("


def holds(kind: int, span: str) -> bool:
    """What a span must hold whoever proposes it."""
    if kind == 0:
        name, sign, domain = re.sub(r"\s*[(\[]\s*at\s*[)\]]\s*|\s*@\s*", "@", span).partition("@")
        domain = re.sub(r"\s*[(\[]\s*dot\s*[)\]]\s*", ".", domain)
        return bool(sign and re.fullmatch(f"[{LOCAL}]+", name) and DOMAIN.fullmatch(domain))
    plain = re.fullmatch(r"[+(]?[0-9][0-9 ().+-]*[0-9]", span)
    number = digits(span)
    if kind == 1:
        parts = re.split(r"\s*\.\s*", span)
        return len(parts) == 4 and all(re.fullmatch("[0-9]{1,3}", p) and int(p) <= 255 for p in parts)
    if kind == 2:
        return bool(plain) and is_card(span)
    # A bare run of digits can be any number; a phone number is written in groups.
    return bool(plain) and is_phone(number) and len(re.findall("[0-9]+", span)) >= 3


def variants(kind: int, span: str, rng: np.random.Generator) -> str:
    """The same data as people also write it, which the patterns miss."""
    if kind == 0:
        return span.replace("@", [" @ ", " (at) ", "[at]"][rng.integers(3)])
    if kind == 1:
        return span.replace(".", [" . ", ". "][rng.integers(2)])
    if kind == 2:
        number, sign = digits(span), ".  "[rng.integers(2)]
        return sign.join(number[i : i + 4] for i in range(0, len(number), 4))
    shorter = span.lstrip("+")
    return [shorter, re.sub(r"^[0-9]+ ", "", shorter), re.sub("[ ()-]+", ".", shorter).strip(".")][rng.integers(3)]


def examples(texts: list[str], rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Windows around labelled spans, as they are and rewritten, and windows without any."""
    wanted, plain = [], []
    for text in texts:
        spans = base_spans(text)
        for start, kind, end in spans:
            before, behind = text[max(0, start - TRAINING_WINDOW) : start], text[end : end + TRAINING_WINDOW]
            near = [s for s in spans if s[0] > start - TRAINING_WINDOW and s[2] < end + TRAINING_WINDOW]
            if len(near) == 1:  # else the context holds labelled data too
                wanted.append((before, kind, text[start:end], behind))
        if not spans and len(text) > 8:
            numbers = [m.start() for m in re.finditer("[0-9@]", text)]
            plain += [text[max(0, i - int(rng.integers(TRAINING_WINDOW))) :] for i in numbers[:3]]
            plain.append(text[int(rng.integers(len(text))) :])
    rng.shuffle(wanted)
    rng.shuffle(plain)
    marks, tags = [], []

    def add(text: str, labels: np.ndarray) -> None:
        row, goal = np.zeros(TRAINING_WINDOW, np.uint8), np.zeros(TRAINING_WINDOW, np.int64)
        cut = symbols(text[:TRAINING_WINDOW])
        row[: len(cut)], goal[: len(cut)] = cut, labels[: len(cut)]
        marks.append(row)
        tags.append(goal)

    # Few spans are shown several times, at other places of the window and written otherwise.
    times = min(MOST_REPEATS, max(1, SAMPLE_WINDOWS // max(1, len(wanted))))
    for before, kind, span, behind in (wanted * times)[:SAMPLE_WINDOWS]:
        for written in (span, variants(kind, span, rng)):
            lead = before[len(before) - int(rng.integers(0, 32)) :] if before else ""
            text = lead + written + behind
            labels = np.zeros(len(text), np.int64)
            labels[len(lead) : len(lead) + len(written)] = kind + 1
            add(text, labels)
    for text in plain[:SAMPLE_WINDOWS]:
        add(text, np.zeros(len(text), np.int64))
    return np.array(marks), np.array(tags)


def fit(
    docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS, seed: int = 11
) -> Tagger | None:
    """Train on a bounded sample of distinct texts, chosen by a hash; None if none has a span."""
    usable = docs.select(text_col).filter(F.length(text_col) <= SAMPLE_CHARS)
    texts = usable.agg(F.approx_count_distinct(text_col)).first()[0]
    place = F.pmod(F.xxhash64(text_col), F.lit(1 << 30)) / (1 << 30)
    sampled = usable.filter(place < sample_rows / max(1, texts)).distinct()
    rows = sampled.orderBy(place, text_col).limit(2 * sample_rows).collect()
    rng = np.random.default_rng(seed)
    windows, tags = examples(sorted({row[0] for row in rows}), rng)
    if not len(windows) or not tags.any():
        return None
    return char_tagger.train(windows, tags, SYMBOLS, 1 + len(KINDS), seed)


def find(docs: DataFrame, tagger: Tagger | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``personal``, an array of (start, order, end, kind, base) by start, then kind.

    Places are code points of the whole text, ends are exclusive; ``base`` tells the spans of
    the patterns. A null or empty text has none; without a tagger there are base spans only.
    Long texts are decoded whole, some windows at a time. Repeated rows are searched each.
    """
    source, names = hidden(docs)
    text = next(k for k, name in names.items() if name == text_col)
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    kind = T.ArrayType(SPAN)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_slices(batches, text, 1 << 20):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            tags = tagged([symbols(t) for t in texts], shared.value) if shared.value else None
            rows = []
            for i, whole in enumerate(texts):
                base = base_spans(whole)
                added = added_spans(whole, tags[i], base) if tags else []
                spans = sorted([(*s, True) for s in base] + [(*s, False) for s in added])
                rows.append([{"start": a, "order": k, "end": b, "kind": KINDS[k], "base": is_base} for a, k, b, is_base in spans])
            yield batch.append_column("personal", pa.array(rows, to_arrow_type(kind)))

    schema = T.StructType([*source.schema.fields, T.StructField("personal", kind)])
    return shown(in_batches(source, search, schema), names, "personal")


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
