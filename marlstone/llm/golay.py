"""Fuzzy hashing with the binary Golay code of length 23.

Every word of 23 bits lies within distance 3 of exactly one code word. A word is
given the index of that code word and, where it lies at distance 3, those of the
five code words at distance 4. Two words that differ in at most two bits then
share an index (a test goes through all cases).
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

LENGTH, MESSAGE = 23, 12
GENERATOR = 0b101011100011  # fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
MOST_KEYS = 6


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, LENGTH - MESSAGE - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - (LENGTH - MESSAGE))
    return word


@lru_cache(1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low and the high half of a word; error patterns of each syndrome, -1 where there are fewer."""
    low = np.array([_remainder(w) for w in range(1 << MESSAGE)], dtype=np.int32)
    high = np.array([_remainder(w << MESSAGE) for w in range(1 << (LENGTH - MESSAGE))], dtype=np.int32)
    unit = [_remainder(1 << b) for b in range(LENGTH)]
    patterns: list[list[int]] = [[] for _ in range(1 << (LENGTH - MESSAGE))]
    for weight in range(5):
        for bits in combinations(range(LENGTH), weight):
            syndrome = 0
            for b in bits:
                syndrome ^= unit[b]
            held = patterns[syndrome]
            if weight < 4 or (held and held[0].bit_count() == 3):
                held.append(sum(1 << b for b in bits))
    errors = np.full((len(patterns), MOST_KEYS), -1, dtype=np.int32)
    for row, held in zip(errors, patterns):
        row[: len(held)] = held
    return low, high, errors


def keys(segment: np.ndarray) -> np.ndarray:
    """Code word indices (12 bits) of each segment, -1 where there are fewer than six; the nearest comes first."""
    low, high, errors = tables()
    segment = segment.astype(np.int32)
    found = errors[low[segment & ((1 << MESSAGE) - 1)] ^ high[segment >> MESSAGE]]
    return np.where(found < 0, -1, (segment[:, None] ^ found) >> (LENGTH - MESSAGE))
