"""Language identification by averaged embeddings of hashed subwords.

Letters are lower-cased, everything else separates words. The runs of one to four characters
of a word, its two edges included, are hashed into buckets; the mean of their embeddings
goes through a linear layer and a softmax. Both are trained by stochastic gradient descent
on a bounded sample. A temperature fitted on a part of the sample left out of the training
makes the probabilities honest, and a limit found there rejects uncertain texts. One more
class, of no language, learns from pieces of the sample whose letters are shuffled or drawn
at random; a text as likely of it as nearly all such pieces of texts left out is rejected.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.columns import by_slices, hidden, in_batches, shown

UNKNOWN = "und"
LONGEST_GRAM = 4
BUCKET_BITS = 16
DIMENSIONS = 16
EPOCHS = 6
RATE = 2.0
FRAGMENT_WORDS = 12  # half of the training examples are short pieces of the sampled texts
# Examples of no language: as many as of a language, or this share of all if that is more.
# They are no shorter than so many words, since a short word may well be one of a language.
NOISE_SHARE = 0.1
NOISE_WORDS = (4, 60)
KEPT_SHARE = 0.999  # of the sampled whole texts left out are not rejected as noise
REJECTED_SHARE = 0.95  # of the noise made of them is, if that leaves them
BLOCK = 1 << 19

# The sample: at most about so many rows, or so many for each language if that is more,
# shared evenly by the languages, each of at most so many characters. Fitting reads no more
# than these, whatever the size of the table. All labelled languages are learned.
SAMPLE_ROWS = 4000
LANGUAGE_ROWS = 20
SAMPLE_CHARS = 20_000

# Of the sampled texts left out, the accepted ones must be right this often. A best language
# that is not even so many times as likely as chance is rejected in any case.
TARGET_PRECISION = 0.99
LEAST_LIFT = 1.2
MOST_LIMIT = 0.5


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    weights: np.ndarray  # of each bucket: its embedding, or that times the linear layer
    bias: np.ndarray
    temperature: float
    limit: float
    layer: np.ndarray | None = None  # where there are more languages than dimensions
    noise_limit: float = 1.0  # texts that are more probably of no language are rejected

    def logits(self, means: np.ndarray) -> np.ndarray:
        return (means if self.layer is None else means @ self.layer) + self.bias

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        """Of each language, and behind them of none."""
        return softmax(self.logits(means) / self.temperature)

    def none(self, texts: list[str]) -> np.ndarray:
        """The chance of each text to be of no language."""
        found = means([code_points(text) for text in texts], self.weights)[0]
        return 1 - self.probabilities(found)[:, : len(self.languages)].sum(axis=1)

    def accepts(self, chances: np.ndarray) -> np.ndarray:
        """Whether the best language is certain enough among languages, and the text is no noise."""
        own = chances[:, : len(self.languages)]
        certain = own.max(axis=1) >= self.limit * own.sum(axis=1)
        return certain & (1 - own.sum(axis=1) <= self.noise_limit)


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


@cache
def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def code_points(text: str) -> np.ndarray:
    """The lower-cased text with 0 for whatever is no letter, and 0 at its ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    return np.concatenate([[0], np.where(letters()[points], points, 0), [0]]).astype(np.uint32)


def grams(points: np.ndarray, starts: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and buckets of the runs of each length that begin at the first ``starts`` points."""
    starts = len(points) if starts is None else starts
    factors = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)
    letter = points != 0
    for length in range(1, LONGEST_GRAM + 1):
        n = min(starts, len(points) - length + 1)
        if n <= 0:
            return
        mixed = np.full(n, length * 0x165667B1 & 0xFFFFFFFF, dtype=np.uint32)
        inside = np.ones(n, dtype=bool)
        for i in range(length):
            mixed += points[i : i + n] * factors[i]
            if 0 < i < length - 1:
                inside &= letter[i : i + n]
        if length == 1:
            inside &= letter[:n]
        elif length == 2:
            inside &= letter[:n] | letter[1 : n + 1]
        places = np.flatnonzero(inside)
        mixed = mixed[places]
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        yield places, (mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


def means(points: list[np.ndarray], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text the mean weights of its subwords, and their number; long texts in blocks."""
    texts, kinds = len(points), weights.shape[1]
    sums, counts = np.zeros((texts, kinds)), np.zeros(texts)
    if not texts:
        return sums, counts
    columns = np.ascontiguousarray(weights.T)  # one at a time, so a block takes little memory
    joined = np.concatenate(points)
    ends = np.cumsum([len(p) for p in points])
    for at in range(0, len(joined), BLOCK):
        block = joined[at : at + BLOCK + LONGEST_GRAM - 1]
        n = min(BLOCK, len(joined) - at)
        owner = np.searchsorted(ends, np.arange(at, at + n), side="right")
        first, last = owner[0], owner[-1] + 1
        owner -= first
        for places, buckets in grams(block, n):
            whose = owner[places]
            counts[first:last] += np.bincount(whose, minlength=last - first)
            for k in range(kinds):
                sums[first:last, k] += np.bincount(whose, columns[k][buckets], minlength=last - first)
    return sums / np.maximum(counts, 1)[:, None], counts


def sample(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int
) -> tuple[DataFrame, int]:
    """Labelled rows taken by a hash of the id, about as many of each language; and how many."""
    usable = docs.filter(
        F.col(lang_col).isNotNull()
        & F.col(text_col).isNotNull()
        & (F.length(text_col) <= SAMPLE_CHARS)
    )
    # One row for each language, which is a class of the model.
    found = usable.groupBy(lang_col).agg(F.count("*").alias("_n")).orderBy(lang_col).collect()
    rows = max(rows, LANGUAGE_ROWS * len(found))
    share = docs.sparkSession.createDataFrame(
        [(lang, rows / len(found) / n) for lang, n in found], "_lang string, _share double"
    )
    place = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1 << 30)) / (1 << 30)
    chosen = usable.join(F.broadcast(share), F.col(lang_col) == F.col("_lang"))
    return chosen.filter(place < F.col("_share")), rows


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    seed: int = 7,
) -> LanguageModel | None:
    """Train on a bounded sample of the labelled rows; None if there are none.

    Rows with a null text or language are not learned from. Only texts and languages are
    used; the id merely picks the sample. ``docs`` must already be without held-out rows.
    """
    labelled = docs.select(id_col, text_col, lang_col)
    chosen, bound = sample(labelled, id_col, text_col, lang_col, sample_rows)
    rows = chosen.select(text_col, lang_col).limit(2 * bound).collect()
    examples = sorted((text, lang) for text, lang in rows if any(map(str.isalpha, text)))
    if not examples:
        return None
    rng = np.random.default_rng(seed)
    languages = sorted({lang for _, lang in examples})
    wanted = np.array([languages.index(lang) for _, lang in examples])
    parts = np.arange(len(examples)) % 5 == 4  # left out for the calibration
    texts = [text for text, _ in examples]
    fragments = [fragment(text, rng) for text in texts]
    every, classes = texts + fragments, np.concatenate([wanted, wanted])
    out = np.concatenate([parts, parts])
    learned = [text for text, left in zip(texts, parts, strict=True) if not left]
    noisy = noise(learned, max(2 * len(learned) // len(languages), int(2 * NOISE_SHARE * len(learned)), 1), rng)
    embedding, layer, bias = descend(
        [counted(text) for text, left in zip(every, out, strict=True) if not left] + [counted(text) for text in noisy],
        np.concatenate([classes[~out], np.full(len(noisy), len(languages))]),
        len(languages) + 1,
        rng,
    )
    # Few languages: the layer goes into the embeddings, so a text takes a number for each.
    few = len(languages) <= DIMENSIONS
    weights, layer = (embedding @ layer, None) if few else (embedding, layer)
    model = LanguageModel(tuple(languages), weights, bias, 1.0, 0.0, layer)
    if not parts.any():
        return model
    left = [text for text, left in zip(every, out, strict=True) if left]
    logits = model.logits(means([code_points(text) for text in left], weights)[0])
    model = calibrated(model, logits[:, : len(languages)], classes[out], parts.sum())
    whole = model.none(left[: parts.sum()])
    other = model.none(noise(left[: parts.sum()], 2 * parts.sum(), rng))
    return replace(model, noise_limit=noise_limit(whole, other))


def noise_limit(whole: np.ndarray, other: np.ndarray) -> float:
    """The most lenient limit that still rejects nearly all noise, if it keeps whole texts."""
    kept = np.quantile(whole, KEPT_SHARE)
    return float(max(kept, np.quantile(other, 1 - REJECTED_SHARE)) if len(other) else kept)


def noise(texts: list[str], number: int, rng: np.random.Generator) -> list[str]:
    """Pieces of texts, words kept in length, with letters shuffled or, in turn, drawn anew."""
    alphabet = np.array(sorted({c for text in texts for c in text.lower() if c.isalpha()}))
    made = []
    for i in range(number):
        words = texts[int(rng.integers(len(texts)))].split()
        size = int(rng.integers(NOISE_WORDS[0], NOISE_WORDS[1] + 1))
        at = int(rng.integers(0, max(1, len(words) - size + 1)))
        chars = np.array(list(" ".join(words[at : at + size]).lower()))
        places = np.flatnonzero([c.isalpha() for c in chars])
        drawn = rng.choice(alphabet, len(places)) if i % 2 else rng.permutation(chars[places])
        chars[places] = drawn
        if len(places):
            made.append("".join(chars))
    return made


def fragment(text: str, rng: np.random.Generator) -> str:
    words = text.split()
    size = int(rng.integers(1, FRAGMENT_WORDS + 1))
    at = int(rng.integers(0, max(1, len(words) - size + 1)))
    piece = " ".join(words[at : at + size])
    return piece if any(map(str.isalpha, piece)) else text


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    buckets = np.concatenate([b for _, b in grams(code_points(text))])
    kinds, counts = np.unique(buckets, return_counts=True)
    return kinds, (counts / counts.sum()).astype(np.float32)


def descend(examples: list, wanted: np.ndarray, kinds: int, rng: np.random.Generator):
    """Stochastic gradient descent over embeddings and linear layer, one example at a time."""
    embedding = rng.normal(0, 0.1, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    layer = rng.normal(0, 0.1, (DIMENSIONS, kinds)).astype(np.float32)
    bias = np.zeros(kinds, np.float32)
    steps, step = EPOCHS * len(examples), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            rate = RATE * (1 - step / steps)
            step += 1
            buckets, shares = examples[i]
            mean = shares @ embedding[buckets]
            error = softmax(mean @ layer + bias)
            error[wanted[i]] -= 1
            back = layer @ error
            layer -= 0.1 * rate * np.outer(mean, error)
            bias -= 0.01 * rate * error
            embedding[buckets] -= 4 * rate * shares[:, None] * back
    return embedding, layer, bias


def calibrated(
    model: LanguageModel, logits: np.ndarray, wanted: np.ndarray, wholes: int | None = None
) -> LanguageModel:
    """With the temperature of least loss, and the least limit that keeps the precision.

    The limit lies a little above chance at least, and never above an even chance against
    all other languages together: a text in two languages is no reason to drop it. Only the
    first ``wholes`` rows count for the limit, those of whole texts: pieces of a few words
    are for the temperature.
    """
    temperatures = np.geomspace(0.25, 8, 61)
    losses = [
        -np.log(np.maximum(softmax(logits / t)[np.arange(len(wanted)), wanted], 1e-9)).mean()
        for t in temperatures
    ]
    temperature = float(temperatures[int(np.argmin(losses))])
    chances = softmax(logits / temperature)
    best, right = chances.max(axis=1)[:wholes], (chances.argmax(axis=1) == wanted)[:wholes]
    limit = 0.0
    chance = LEAST_LIFT / len(model.languages)
    for candidate in np.linspace(min(chance, MOST_LIMIT), MOST_LIMIT, 51):
        limit = float(candidate)
        accepted = best >= candidate
        if not accepted.any() or right[accepted].mean() >= TARGET_PRECISION:
            break
    return replace(model, temperature=temperature, limit=limit)


def identify(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and accepted.

    A text that is null, empty or without a letter has language ``und``, score 0 and is not
    accepted; so has every text if there is no model. Whole texts of any length are read, in
    blocks. A text whose score is below the model's limit, or that is more probably of no
    language than the model allows, keeps its best language, but is not accepted. The limit of
    the score holds among languages, the score itself counts the chance of none as well. Ties go to the language first in the alphabet. Rows stay as they are.
    """
    source, names = hidden(docs)
    text = next(k for k, name in names.items() if name == text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in by_slices(batches, text, 1 << 20):
            found, scores, accepted = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows, [False] * batch.num_rows
            if known:
                points = [code_points(t or "") for t in batch.column(text).to_pylist()]
                averages, counts = means(points, known.weights)
                chances = known.probabilities(averages)
                taken = known.accepts(chances)
                for i, best in enumerate(chances[:, : len(known.languages)].argmax(axis=1)):
                    if counts[i]:
                        found[i], scores[i] = known.languages[best], float(chances[i, best])
                        accepted[i] = bool(taken[i])
            columns = [pa.array(found), pa.array(scores), pa.array(accepted)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], [*batch.schema.names, "lang_pred", "score", "accepted"]
            )

    added = [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("accepted", T.BooleanType()),
    ]
    judged = in_batches(source, judge, T.StructType([*source.schema.fields, *added]))
    return shown(judged, names, "lang_pred", "score", "accepted")


def fold(id_col: str, folds: int = 5) -> Column:
    """The remainder of the CRC-32 of the id as text; 0, the held-out fold, for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds)), F.lit(0))
