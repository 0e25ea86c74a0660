"""Fuzzy keys of short bit strings from the perfect binary Golay code.

Every word of 23 bits lies within distance 3 of exactly one of the 4,096 code words, so decoding maps it to that code
word's index of 12 bits. Two words at distance 1 are of different parity: the even one is in the ball of radius 1 around
the odd one, so the indices that this ball decodes to hold the even one's own index. A ball decodes to one index, or to
six where its centre is at distance 3 from the code word.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

LENGTH, DIMENSION = 23, 12
#: Fixed value: the generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


@lru_cache(maxsize=1)
def decoder() -> np.ndarray:
    """The code word index of each of the 2^23 words: 16 MB, made once in a worker."""
    index = np.arange(1 << DIMENSION, dtype=np.uint32)
    codes = np.zeros_like(index)
    for bit in range(DIMENSION):
        codes ^= np.where(index >> bit & 1, np.uint32(GENERATOR << bit), np.uint32(0))
    table = np.empty(1 << LENGTH, dtype=np.uint16)
    for weight in range(4):
        for places in combinations(range(LENGTH), weight):
            table[codes ^ np.uint32(sum(1 << p for p in places))] = index
    return table


def one_error_keys(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices (at most bits + 1 a row) and which of them count, for words of `bits` bits: words that differ in exactly
    one bit share a counting index."""
    table = decoder()
    flips = np.concatenate(([0], 1 << np.arange(bits))).astype(np.uint32)
    found = table[words.astype(np.uint32)[:, None] ^ flips[None, :]]
    own = found[:, :1].copy()
    found.sort(axis=1)
    fresh = np.ones(found.shape, dtype=bool)
    fresh[:, 1:] = found[:, 1:] != found[:, :-1]
    even = np.bitwise_count(words) % 2 == 0
    fresh[even] = found[even] == own[even]
    fresh[even, 1:] &= found[even, 1:] != found[even, :-1]
    return found, fresh
