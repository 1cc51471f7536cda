"""The perfect binary Golay code of 23 bits: 4096 codewords, every word within 3 bits of one."""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

# Fixed values of the code: its length, its message length and its generating polynomial,
# x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
LENGTH, MESSAGE = 23, 12
GENERATOR = 0b101011100011
CHECK = LENGTH - MESSAGE


@cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainder of each message part, and the error of at most 3 bits for each remainder."""
    remainder = np.zeros(1 << MESSAGE, dtype=np.uint32)
    for i in range(MESSAGE):
        rest = 1 << (CHECK + i)
        for bit in range(CHECK + i, CHECK - 1, -1):
            if rest >> bit & 1:
                rest ^= GENERATOR << (bit - CHECK)
        remainder[1 << i : 2 << i] = remainder[: 1 << i] ^ rest
    patterns = [
        sum(1 << bit for bit in bits) for n in range(4) for bits in combinations(range(LENGTH), n)
    ]
    errors = np.zeros(1 << CHECK, dtype=np.uint32)
    found = np.array(patterns, dtype=np.uint32)
    errors[(found & ((1 << CHECK) - 1)) ^ remainder[found >> CHECK]] = found
    return remainder, errors


def index(words: np.ndarray) -> np.ndarray:
    """The number of the nearest codeword, of 12 bits."""
    remainder, errors = tables()
    syndrome = (words & ((1 << CHECK) - 1)) ^ remainder[words >> CHECK]
    return (words ^ errors[syndrome]) >> CHECK


def near_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all codewords nearest to a word or to a word one bit from it.

    There are one or six of them. Two words that differ in one bit have the number of either
    among those of the other; two that differ in two bits have one in common. Returns an
    array of six columns and the mask of the valid ones.
    """
    flips = np.concatenate([[0], 1 << np.arange(LENGTH)]).astype(np.uint32)
    every = np.sort(index(words.astype(np.uint32)[:, None] ^ flips), axis=1)
    new = np.ones(every.shape, dtype=bool)
    new[:, 1:] = every[:, 1:] != every[:, :-1]
    order = np.argsort(~new, axis=1, kind="stable")[:, :6]
    return np.take_along_axis(every, order, 1), np.take_along_axis(new, order, 1)
