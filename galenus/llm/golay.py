"""The perfect binary Golay code (23, 12, 7) as a fuzzy hash.

Every 23-bit word lies within distance 3 of exactly one codeword. The keys of a
word are the codewords within distance 4: one (words within 2 of a codeword) or
six. Two words that differ in at most two bits share a key: the word halfway
between them is within 1 of both and within 3 of some codeword.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

BITS, CHECK_BITS, GENERATOR = 23, 11, 0b101011100011
SEGMENTS = ((0, 23), (23, 23), (46, 18))


def _remainder(word: int) -> int:
    for bit in range(BITS - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits, and the error patterns of each syndrome with their number."""
    unit = [_remainder(1 << i) for i in range(BITS)]

    def linear(units: list[int]) -> np.ndarray:
        out = np.zeros(1 << len(units), dtype=np.uint32)
        for i, u in enumerate(units):
            out[1 << i : 2 << i] = out[: 1 << i] ^ u
        return out

    patterns: list[list[int]] = [[] for _ in range(1 << CHECK_BITS)]
    for weight in range(5):
        for bits in combinations(range(BITS), weight):
            syndrome = 0
            for b in bits:
                syndrome ^= unit[b]
            patterns[syndrome].append(sum(1 << b for b in bits))
    number = np.array([len(p) for p in patterns])
    table = np.zeros((len(patterns), number.max()), dtype=np.uint32)
    for i, p in enumerate(patterns):
        table[i, : len(p)] = p
    return linear(unit[:12]), linear(unit[12:]), table, number


def word_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (12 bits) of the codewords within distance 4 of each word, and a mask of those that count."""
    low, high, table, number = _tables()
    syndrome = low[words & 0xFFF] ^ high[words >> 12]
    index = (words[:, None] ^ table[syndrome]) >> CHECK_BITS
    return index.astype(np.int64), np.arange(table.shape[1]) < number[syndrome][:, None]


def fingerprint_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) pairs such that 64-bit fingerprints within 4 bits share a key.

    The 64 bits are three segments of 23, 23 and 18 bits with a, b and c errors,
    a + b + c <= 4. If one segment has no error, the smaller error of the other
    two is at most 2: the exact segment with the Golay key of that one is shared.
    Otherwise each has 1 or 2 errors: the Golay keys of the first two segments
    are shared, and one of the third's three blocks of 6 bits is exact.
    """
    f = fingerprints.astype(np.uint64)
    words = [((f >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.uint32) for at, n in SEGMENTS]
    keyed = [word_keys(w) for w in words]
    rows, keys = [], []

    def put(tag: int, key: np.ndarray, mask: np.ndarray) -> None:
        at = np.nonzero(mask)
        rows.append(at[0])
        keys.append((np.int64(tag) << 40) | key[at])

    tag = 0
    for i in range(3):
        for j in range(3):
            if i != j:
                put(tag, (words[i].astype(np.int64)[:, None] << 12) | keyed[j][0], keyed[j][1])
                tag += 1
    (a, in_a), (b, in_b) = keyed[:2]
    both = ((a[:, :, None] << 12) | b[:, None, :]).reshape(len(f), -1)
    mask = (in_a[:, :, None] & in_b[:, None, :]).reshape(len(f), -1)
    for block in range(3):
        exact = ((words[2] >> (6 * block)) & 63).astype(np.int64)[:, None]
        put(tag + block, (both << 6) | exact, mask)
    return np.concatenate(rows), np.concatenate(keys)


@cache
def ball_masks(bits: int = 64, radius: int = 2) -> np.ndarray:
    """All masks of at most ``radius`` set bits. Words that meet in one ball's centre are within ``2 * radius``."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)], dtype=np.uint64)
