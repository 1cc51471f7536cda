"""Secrets by fixed patterns and by Markov models of characters.

Two first-order models, of random strings and of ordinary identifiers, are counted from
labelled samples: what the patterns find, and the words left when it is taken out. A long
token among those counts as ordinary only in the shape of words and numbers; any other may be
a secret that no pattern finds, and teaches nothing. A run of identifier characters is a
secret if the log-likelihood ratio of the two is high enough, whatever it is made of; UUIDs
within it say nothing, and names in code are read as their words.
Counting, scoring and finding places are DataFrame functions throughout.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.columns import hidden, shown

# The patterns of the base kinds, in order.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "random")

# Without a word of white space or punctuation between, so that a model can judge it.
RUN = r"[A-Za-z0-9+/=_-]+"
LEAST_RUN = 16
SEPARATORS = "+/=_-"  # say nothing about what surrounds them
CODES = 128
SYMBOLS = 62  # letters and digits

# Fixed value: the shape of a UUID. It is random by design and no secret, so it says nothing.
UUID = r"(?i)(?<![0-9a-z])[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}(?![0-9a-z])"

# Words, humps and numbers between separators; possessive, so that no token outgrows the stack.
WORD = "(?:[A-Z]++|[A-Z]?[a-z]++(?:[A-Z][a-z]{2,}+)*+)[0-9]{0,4}+|[0-9]++"
NAME = WORD.replace("{2,}", "")  # humps of one letter as well: enough to read, not to learn from
HUMP = "(?<=[a-z0-9])(?=[A-Z])"
ORDINARY, NAMES = (rf"^[+/=_-]*+(?:(?:{word})(?:[+/=_-]++|$))*+$" for word in (WORD, NAME))

SAMPLE_ROWS = 4000  # about so many texts teach the models, whatever the size of the table
SMOOTHING = 0.5
LEAST_SCORE = 8.0  # nats
MARGIN = 4.0  # above nearly all ordinary identifiers
ORDINARY_SHARE = 0.999

SPANS = "array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class SecretModel:
    """Log-likelihood ratio of each pair of characters, and the least score of a secret."""

    ratios: tuple[float, ...]
    limit: float


def at_least(pattern: str, least: int) -> str:
    """The runs of ``pattern`` that long; a run is never cut, so none is found otherwise."""
    return f"{pattern.removesuffix('+')}{{{least},}}"


# A run of hex digits is taken whole either way, and so are characters behind AKIA.
LONG_HEX = at_least(HEX, LEAST["hex"])
LONG_ACCESS = at_least(ACCESS, LEAST["access"] - 4)
LONG_RUN = at_least(RUN, LEAST_RUN)


def all_of(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def nothing(kind: str) -> Column:
    return F.from_json(F.lit("[]"), kind)


def placed(text: Column, pattern: str, matches: Column, wanted: Column) -> Column:
    """Start and end in code points of the wanted matches, from what lies between them."""
    gaps = F.split(text, pattern, -1)
    sizes = F.zip_with(
        F.zip_with(gaps, matches, lambda g, m: F.struct(F.char_length(g).alias("gap"), F.char_length(m).alias("size"))),
        wanted,
        lambda x, ok: F.struct(x["gap"].alias("gap"), x["size"].alias("size"), ok.alias("ok")),
    )
    inner = F.filter(sizes, lambda x: x["size"].isNotNull())
    start = F.struct(F.lit(0).alias("at"), nothing(SPANS).alias("out"))

    def step(done: Column, x: Column) -> Column:
        begin = done["at"] + x["gap"]
        end = begin + x["size"]
        found = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(
            end.alias("at"),
            F.when(x["ok"], F.concat(done["out"], found)).otherwise(done["out"]).alias("out"),
        )

    return F.when(
        F.exists(wanted, lambda ok: ok), F.aggregate(inner, start, step, lambda done: done["out"])
    ).otherwise(nothing(SPANS))


def with_base_spans(rows: DataFrame, text: str) -> DataFrame:
    """Columns _assign, _access and _hex: arrays of spans."""
    whole = F.col(text)
    may_assign = whole.contains("=") | whole.contains(":")
    rows = rows.withColumns(
        {
            "_m_assign": F.when(may_assign, all_of(whole, ASSIGN)).otherwise(nothing("array<string>")),
            "_m_access": F.when(whole.contains("AKIA"), all_of(whole, LONG_ACCESS)).otherwise(nothing("array<string>")),
            "_m_hex": all_of(whole, LONG_HEX),
        }
    )
    long_value = F.transform(
        F.when(F.size("_m_assign") > 0, all_of(whole, ASSIGN, 2)).otherwise(nothing("array<string>")),
        lambda value: F.char_length(value) >= LEAST["assign"],
    )
    always = {k: F.transform(F.col(f"_m_{k}"), lambda m: m.isNotNull()) for k in ("access", "hex")}
    rows = rows.withColumn("_v_assign", long_value)
    return rows.withColumns(
        {
            "_assign": placed(whole, ASSIGN, F.col("_m_assign"), F.col("_v_assign")),
            "_access": placed(whole, LONG_ACCESS, F.col("_m_access"), always["access"]),
            "_hex": placed(whole, LONG_HEX, F.col("_m_hex"), always["hex"]),
        }
    )


def codes(token: Column) -> Column:
    """The characters of an ASCII string as numbers."""
    return F.transform(F.filter(F.split(token, ""), lambda c: c != ""), F.ascii)


def pairs(numbers: Column) -> Column:
    """The number of each pair of neighbours."""
    behind = F.slice(numbers, 2, F.greatest(F.size(numbers), F.lit(1)))
    return F.filter(
        F.zip_with(numbers, behind, lambda a, b: a * CODES + b), lambda pair: pair.isNotNull()
    )


def score(token: Column, ratios: Column, once: bool = False) -> Column:
    """The sum of all pairs, or of the distinct ones, so that no repetition adds evidence."""
    each = F.array_distinct(pairs(codes(token))) if once else pairs(codes(token))
    return F.aggregate(each, F.lit(0.0), lambda sum_, pair: sum_ + F.get(ratios, pair))


def without_ids(token: Column) -> Column:
    """The token with a separator for each identifier of a known public shape."""
    return F.when(token.contains("-"), F.regexp_replace(token, UUID, "-")).otherwise(token)


def evidence(token: Column, ratios: Column) -> Column:
    """The score of a token as the models should read it.

    Identifiers of a public shape say nothing. A token in the shape of words and numbers is
    read as lower-case words, parted at its humps: names in code have pairs that prose lacks.
    A pair that comes again says nothing new, so a long run of the same is no secret.
    """
    words = F.lower(F.regexp_replace(token, HUMP, "-"))
    shaped = token.rlike("[A-Z]") & token.rlike(NAMES)
    return score(F.when(shaped, words).otherwise(without_ids(token)), ratios, once=True)


def ratio_column(model: SecretModel) -> Column:
    """The table as one constant, which the optimiser folds."""
    return F.split(F.lit(",".join(map(repr, model.ratios))), ",").cast("array<double>")


def labelled_tokens(docs: DataFrame, text: str) -> DataFrame:
    """Distinct tokens with ``random``, whether a base pattern has found them, and ``n``.

    Of the others, long ones that are not made of words and numbers are left out: they may be
    secrets as well as not, however many there are.
    """
    whole = F.col(text)
    values = F.concat(
        F.filter(all_of(whole, ASSIGN, 2), lambda v: F.char_length(v) >= LEAST["assign"]),
        all_of(whole, LONG_ACCESS),
        all_of(whole, LONG_HEX),
    )
    rest = whole
    for pattern in (ASSIGN, LONG_ACCESS, LONG_HEX):
        rest = F.regexp_replace(rest, pattern, " ")
    found = docs.select(F.explode(values).alias("token"), F.lit(True).alias("random"))
    others = docs.select(F.explode(all_of(rest, RUN)).alias("token"), F.lit(False).alias("random"))
    others = others.filter((F.length("token") < LEAST_RUN) | F.col("token").rlike(ORDINARY))
    return found.unionByName(others).groupBy("token", "random").agg(F.count("*").alias("n"))


def fit(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> SecretModel:
    """Count the models on about ``sample_rows`` whole texts, chosen by a hash.

    Each text counts once, however many documents hold it.
    Pairs that a model has not seen get a smoothed share, so without any secret in the sample
    random strings are those of even pairs. A separator says nothing. The limit lies above
    the scores of nearly all long tokens of the sample that are known to be ordinary.
    """
    texts = max(1, docs.agg(F.approx_count_distinct(text_col)).first()[0])
    place = F.pmod(F.xxhash64(text_col), F.lit(1 << 30)) / (1 << 30)
    sampled = docs.filter(F.col(text_col).isNotNull() & (place < sample_rows / texts))
    sampled = sampled.select(text_col).distinct()
    tokens = labelled_tokens(sampled, text_col).persist()
    try:
        counted = (
            tokens.select("random", "n", F.explode(pairs(codes(F.col("token")))).alias("pair"))
            .groupBy("random", "pair")
            .agg(F.sum("n").alias("n"))
            .collect()  # a row for each kind and pair of ASCII characters at most
        )
        ratios = ratios_of({(row.random, row.pair): row.n for row in counted})
        model = SecretModel(ratios, LEAST_SCORE)
        long_ones = tokens.filter(~F.col("random") & (F.length("token") >= LEAST_RUN))
        usual = long_ones.agg(
            F.percentile_approx(evidence(F.col("token"), ratio_column(model)), ORDINARY_SHARE, 10_000)
        ).first()[0]
    finally:
        tokens.unpersist()
    return SecretModel(ratios, LEAST_SCORE if usual is None else max(LEAST_SCORE, usual + MARGIN))


def ratios_of(counts: dict[tuple[bool, int], int]) -> tuple[float, ...]:
    silent = {ord(c) for c in SEPARATORS}
    totals: dict[tuple[bool, int], int] = {}
    for (random, pair), n in counts.items():
        if not {pair // CODES, pair % CODES} & silent:
            key = random, pair // CODES
            totals[key] = totals.get(key, 0) + n

    def chance(random: bool, pair: int) -> float:
        seen = counts.get((random, pair), 0) + SMOOTHING
        return seen / (totals.get((random, pair // CODES), 0) + SMOOTHING * SYMBOLS)

    return tuple(
        0.0
        if {pair // CODES, pair % CODES} & silent
        else round(math.log(chance(True, pair) / chance(False, pair)), 6)
        for pair in range(CODES * CODES)
    )


def scan(docs: DataFrame, model: SecretModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``secrets``, an array of (start, kind, end, order), by start, then kind.

    Places are code points of the whole text, ends are exclusive. The base kinds are found
    leftmost first, without overlap within a kind; random strings that the models add
    overlap no base span. A null or empty text has none. Repeated rows are scanned each.
    """
    source, names = hidden(docs)
    given = next(k for k, name in names.items() if name == text_col)
    rows = source.withColumn("_text", F.coalesce(F.col(given), F.lit("")))
    rows = with_base_spans(rows, "_text").withColumn("_m_random", all_of(F.col("_text"), LONG_RUN))
    ratios = ratio_column(model)
    likely = F.transform(F.col("_m_random"), lambda run: evidence(run, ratios) >= model.limit)
    rows = rows.withColumn("_v_random", likely)
    rows = rows.withColumn("_random", placed(F.col("_text"), LONG_RUN, F.col("_m_random"), F.col("_v_random")))
    base = F.concat("_assign", "_access", "_hex")
    new = F.filter(
        F.col("_random"),
        lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )

    def named(spans: Column, order: int) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.lit(order).alias("order"),
                s["end"].alias("end"),
                F.lit(KINDS[order]).alias("kind"),
            ),
        )

    every = F.concat(
        named(F.col("_assign"), 0), named(F.col("_access"), 1), named(F.col("_hex"), 2), named(new, 3)
    )
    return shown(rows.withColumn("secrets", F.array_sort(every)), names, "secrets")


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def masked(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """The text with each stretch covered by spans replaced; touching ones become one.

    ``spans`` must be in order of their starts.
    """
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        fresh = s["start"] >= done["at"]
        between = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        out = F.when(fresh, F.concat(done["out"], between, F.lit(mask))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    def finish(done: Column) -> Column:
        return F.concat(done["out"], F.substring(text, done["at"] + 1, F.char_length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, begin, step, finish)).otherwise(text)
