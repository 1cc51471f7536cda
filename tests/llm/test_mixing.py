"""Mixing: targets, blocks and the schedule of slots, against plain Python."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from fractions import Fraction
from hashlib import sha256

import pytest

from meterline.llm import mixing

DOCS = "doc_id long, text string, source string, size string, _row int"


def frame_of(spark, docs):
    return spark.createDataFrame([(i, text, source, "x", 7) for i, text, source in docs], DOCS)


def plain_mix(docs: list[tuple], weights=(1, 2, 3), times=3) -> list[tuple]:
    """Targets by sharing the excess again and again; whole rounds of a source, then its first words."""
    rows = [(i, len(re.findall(r"[^\x20\x09-\x0D]+", text or "")), source) for i, text, source in docs]
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, s))
    size = {s: sum(n for _, n, x in rows if x == s) for s in names}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = {s: Fraction(0) for s in names}
    rest, free = Fraction(sum(size.values())), set(names)
    while rest and free:
        share, total = rest, sum(weight[s] for s in free)
        for s in free:
            target[s] += share * weight[s] / total
        rest = sum(max(Fraction(0), target[s] - times * size[s]) for s in names)
        target = {s: min(t, Fraction(times * size[s])) for s, t in target.items()}
        free = {s for s in free if target[s] < times * size[s]}
    out = []
    for s in names:
        own = [(int(sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:15], 16), i, n) for i, n, x in rows if x == s]
        goal, begin = int(target[s]), 0
        for _, i, n in sorted(own, key=lambda r: (r[0], r[1] is not None, r[1])):
            rounds, more = divmod(goal, size[s]) if size[s] else (0, 0)
            out.append((i, n, size[s], float(target[s]), rounds * n + max(0, min(n, more - begin))))
            begin += n
    return out


def some_docs(n=400, hot=0.4):
    docs = [(i, "w " * (1 + i * 37 % 90), "hot" if i % 10 < 10 * hot else f"s{i % 7}") for i in range(n)]
    return docs + [(9000, None, "s1"), (9001, "", "s2"), (9002, " \t\x0b", None), (9003, "null source é " * 40, None),
                   (9004, "tiny", "alone"), (9005, None, "empty"), (9006, "long " * 20_000, "s3"), (None, "no id " * 30, "s4")]


def comparable(rows):
    return sorted(((i, n, m, round(t, 6), k) for i, n, m, t, k in rows), key=repr)


@pytest.mark.parametrize("block_words", [1, 1024])
def test_mix_equals_plain_python(spark, block_words):
    docs = some_docs()
    found = mixing.mix(frame_of(spark, docs).repartition(5), block_words=block_words)
    assert found.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert comparable(map(tuple, found.collect())) == comparable(plain_mix(docs))


def test_targets_of_many_small_sources(spark):
    """Small sources become full in turn, and what is over goes on to the others."""
    docs = [(i, "w " * (1 + (i * i) % 500), f"s{i:03}") for i in range(60)] + [(100, "w " * 90_000, "z")]
    found = mixing.mix(frame_of(spark, docs)).collect()
    assert comparable(map(tuple, found)) == comparable(plain_mix(docs))
    assert all(r.taken <= 3 * r.size for r in found)
    # Each target loses less than a word.
    assert sum(r.size for r in found) - 61 < sum(r.taken for r in found) <= sum(r.size for r in found)


def test_the_schedule_is_even_and_takes_whole_blocks(spark):
    docs = some_docs()
    known, mix = mixing.plan(frame_of(spark, docs), block_words=50)
    rows = mix.join(known.select("_row", "_number", "source_size", "target"), "_row").collect()
    words, owner, blocks = Counter(), {}, defaultdict(list)
    for r in rows:
        words[r.slot] += r.words
        assert owner.setdefault(r.slot, r._number) == r._number
    for slot in sorted(owner):
        blocks[owner[slot]].append(next(r.block for r in rows if r.slot == slot) if len(blocks[owner[slot]]) < 30 else None)
    for taken in blocks.values():  # in turn, beginning again after the last
        seen = [b for b in taken if b is not None]
        assert all(b == a + 1 or b == 0 for a, b in zip(seen, seen[1:]))
    counts, slots = Counter(owner.values()), sorted(owner)
    last = {number: max(s for s in owner if owner[s] == number) for number in counts}
    assert all(25 < words[s] <= 50 for s in slots if s != last[owner[s]] and counts[owner[s]] > 9)
    # Every stretch has nearly the shares of the whole.
    for at in range(0, len(slots) - 200, 100):
        here = Counter(owner[s] for s in slots[at : at + 200])
        assert all(abs(here[n] - 200 * counts[n] / len(slots)) <= 6 for n in counts)


def test_words_of_a_document_lie_inside_it(spark):
    known, mix = mixing.plan(frame_of(spark, some_docs()), block_words=64)
    size = {r._row: r.size for r in known.collect()}
    used = defaultdict(Counter)
    for r in mix.collect():
        assert 0 <= r.start and r.words > 0 and r.start + r.words <= size[r._row]
        used[r._row].update(range(r.start, r.start + r.words))
    assert all(max(c.values()) - min(c[w] for w in range(size[row])) <= 1 for row, c in used.items())


def test_reruns_agree_and_repeated_rows_stay(spark):
    docs = some_docs(60) * 2
    first, second = (sorted(mixing.mix(frame_of(spark, docs).repartition(n)).collect(), key=repr) for n in (3, 3))
    assert first == second and len(first) == len(docs)


def test_nothing_to_mix(spark):
    assert mixing.mix(frame_of(spark, [])).count() == 0
    (row,) = mixing.mix(frame_of(spark, [(1, None, "a")])).collect()
    assert (row.size, row.source_size, row.target, row.taken) == (0, 0, 0.0, 0)


def test_points_do_not_overflow(spark):
    slots = [0, 1, 2, 524_287, 524_288, 10**9, 3 * 10**11, 2**62]
    column = mixing.point(mixing.F.col("id"))
    found = spark.createDataFrame([(s,) for s in slots], "id long").select(column).collect()
    assert [r[0] for r in found] == [s * mixing.GOLDEN % (1 << 38) for s in slots]
