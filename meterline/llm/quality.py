"""Quality rules as a ledger of bits.

Every text is measured once. Every rule sets one bit of a number if the measurements fail
it; numbers and measurements are the ledger. A policy is a version, a mask of rules that
each reject, and optionally further rules of which a number must fail. Policies are applied,
compared and taken apart on the ledger alone, without reading a text again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.bpe import per_text
from meterline.session import cut_lineage

WINDOW = 8
SYMBOLS = b"#*$%&|<>"

MEASUREMENTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_echoes",
    "n_plain_words",
)


@dataclass(frozen=True)
class Rule:
    """``fails`` is an SQL condition over the measurements, true for a text to be rejected."""

    name: str
    fails: str


@dataclass(frozen=True)
class Policy:
    """Rejects what fails any of ``rules``, or at least ``weak_limit`` of ``weak_rules``."""

    version: int
    rules: tuple[str, ...]
    weak_rules: tuple[str, ...] = ()
    weak_limit: int = 2


# A rule keeps its bit for ever: new ones go to the end, and a changed one gets a new name.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("many_symbols", "10 * n_symbols > 3 * n_words"),
    Rule("echoed_words", "10 * n_echoes > 3 * n_words"),
    Rule("long_words", "word_chars > 25 * n_words"),
    Rule("short_words", "2 * word_chars < 3 * n_words"),
    Rule("few_plain_words", "10 * n_plain_words < 3 * n_words"),
    Rule("repeated_lines", "n_lines >= 5 and 10 * n_dup_lines > 5 * n_lines"),
    Rule("some_symbols", "10 * n_symbols > n_words"),
    Rule("some_repeated_lines", "n_lines >= 5 and 10 * n_dup_lines > 3 * n_lines"),
    Rule("some_echoes", "10 * n_echoes > n_words"),
)

BASE = ("few_words", "repeated_windows")
BASIC = Policy(1, BASE)
STANDARD = Policy(
    2,
    (*BASE, "many_symbols", "echoed_words", "long_words", "short_words", "few_plain_words", "repeated_lines"),
    ("some_symbols", "some_repeated_lines", "some_echoes"),
)


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a run of ``window`` words found at least twice in the text.

    Runs are numbered exactly: equal runs of one word get one number, and a run twice as long
    the number of its pair of halves. ``window`` is a power of two.
    """
    if len(ids) <= window:
        return 0
    length = 1
    while length < window:
        pairs = ids[:-length] * (int(ids.max()) + 1) + ids[length:]
        ids = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        length *= 2
        if length < window and ids.max() + 1 == len(ids):
            return 0  # all runs differ already
    again = np.flatnonzero(np.bincount(ids)[ids] > 1)
    if not len(again):
        return 0
    gaps = np.minimum(np.diff(again, append=again[-1] + window), window)
    return int(gaps.sum())


def measure(text: str) -> tuple[int, ...]:
    data = text.encode()
    words = data.split()  # bytes are split at ASCII white space only
    n = len(words)
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    solid = b"".join(words)
    chars = len(solid.decode())
    # Lines are compared whole; only those with a word count.
    lines = [line for line in data.split(b"\n") if line.split()]
    return (
        n,
        chars,
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(ids),
        len(lines),
        int((ids[1:] == ids[:-1]).sum()),
        plain_words(ids, numbers),
    )


def has_letter(word: bytes) -> bool:
    return word.isalpha() or any(map(str.isalpha, word.decode()))


def plain_words(ids: np.ndarray, numbers: dict[bytes, int]) -> int:
    plain = np.fromiter(map(has_letter, numbers), bool, len(numbers))
    return int(plain[ids].sum())


def ledger(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with all measurements and ``failed``, one bit for each rule in order.

    Words are runs of anything but ASCII white space. A null text is empty: it has no word,
    every measurement is 0, and it fails the rules that ask for words. Lines without a word
    are no lines. Long texts are measured whole. Repeated rows are measured each.
    """
    if len(rules) > 63:
        raise ValueError("a ledger holds 63 rules")
    fields = [T.StructField(name, T.LongType()) for name in MEASUREMENTS]
    measured = per_text(docs, text_col, fields, measure)
    return measured.withColumn("failed", failed_bits(rules))


def failed_bits(rules: Sequence[Rule] = RULES) -> Column:
    bits = [F.when(F.expr(rule.fails), F.lit(1 << i).cast("long")).otherwise(0) for i, rule in enumerate(rules)]
    total = F.lit(0).cast("long")
    for bit in bits:
        total = total.bitwiseOR(bit)
    return total


def mask(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    place = {rule.name: i for i, rule in enumerate(rules)}
    return sum(1 << place[name] for name in names)


def verdict(policy: Policy, rules: Sequence[Rule] = RULES, failed: Column | None = None) -> Column:
    """Whether the policy keeps a row of the ledger, or one with the bits ``failed``."""
    failed = F.col("failed") if failed is None else failed
    strong, weak = mask(policy.rules, rules), mask(policy.weak_rules, rules)
    few = F.bit_count(failed.bitwiseAND(F.lit(weak))) < policy.weak_limit
    return (failed.bitwiseAND(F.lit(strong)) == 0) & few


def ablations(
    entries: DataFrame, policy: Policy = STANDARD, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """For each rule of a policy: rows that fail it, and rows that it alone rejects.

    One row for each rule, from one aggregation over the ledger: the rule is taken out of the
    policy by clearing its bit. ``changed`` rows would be kept without it. An empty ledger
    gives zeros.
    """
    names = [*policy.rules, *policy.weak_rules]
    kept = verdict(policy, rules)
    sums = []
    for name in names:
        without = F.col("failed").bitwiseAND(F.lit(~mask([name], rules)))
        kept_without = verdict(policy, rules, without)
        hit = F.col("failed").bitwiseAND(F.lit(mask([name], rules))) != 0
        sums += [F.count_if(hit), F.count_if(kept_without & ~kept)]
    totals = entries.agg(F.array(*sums).alias("_n"), F.count("*").alias("n_rows"))
    each = [
        F.struct(
            F.lit(policy.version).alias("version"),
            F.lit(name).alias("rule"),
            F.col("_n")[2 * i].alias("failed"),
            F.col("_n")[2 * i + 1].alias("changed"),
            F.col("n_rows"),
        )
        for i, name in enumerate(names)
    ]
    return totals.select(F.explode(F.array(*each)).alias("_row")).select("_row.*")


def stored_ledger(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The ledger without the texts, written to the shared folder: no policy reads a text again."""
    return cut_lineage(ledger(docs, text_col, rules).drop(text_col))


def apply_policy(entries: DataFrame, policy: Policy = STANDARD, rules: Sequence[Rule] = RULES) -> DataFrame:
    """A ledger with base_failed, kept and policy_version, the version that judged."""
    base = F.col("failed").bitwiseAND(F.lit(mask(BASE, rules))) != 0
    return entries.withColumns(
        {
            "base_failed": base,
            "kept": ~base & verdict(policy, rules),
            "policy_version": F.lit(policy.version),
        }
    )


def judge(docs: DataFrame, text_col: str = "text", policy: Policy = STANDARD) -> DataFrame:
    """The ledger of ``docs``, texts included, with base_failed, kept and policy_version."""
    return apply_policy(ledger(docs, text_col), policy)
