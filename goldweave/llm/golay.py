"""The perfect binary Golay code (23, 12, 7): every 23-bit word lies within three bits of exactly one codeword.

The tables follow from the generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1. A codeword is named by its upper
twelve bits (its index). Two words at most two bits apart have a common neighbour at most one bit from both, so the
indices of all words within one bit of either always meet: ball() gives them, one to six for each word."""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

N, CHECK, GENERATOR = 23, 11, 0xAE3


def _remainder(v: int) -> int:
    for i in range(N - 1, CHECK - 1, -1):
        if v >> i & 1:
            v ^= GENERATOR << (i - CHECK)
    return v


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    unit = [_remainder(1 << i) for i in range(N)]
    low, high = np.zeros(1 << 12, np.uint32), np.zeros(1 << CHECK, np.uint32)
    for i in range(N):
        part, bit = (low, i) if i < 12 else (high, i - 12)
        part ^= ((np.arange(len(part), dtype=np.uint32) >> bit) & 1) * np.uint32(unit[i])
    error = np.zeros(1 << CHECK, np.uint32)
    for weight in (1, 2, 3):
        for bits in combinations(range(N), weight):
            s = 0
            for i in bits:
                s ^= unit[i]
            error[s] = sum(1 << i for i in bits)
    return low, high, error


def decode(v: np.ndarray) -> np.ndarray:
    """Index of the nearest codeword of each 23-bit word."""
    low, high, error = _tables()
    v = v.astype(np.uint32)
    return (v ^ error[low[v & 0xFFF] ^ high[v >> 12]]) >> CHECK


def ball(v: np.ndarray, bits: int = N) -> np.ndarray:
    """One row for each word: the sorted indices of it and of its neighbours in the lowest `bits`; repeats follow the
    first as -1."""
    flips = np.concatenate([[0], 1 << np.arange(bits)]).astype(np.uint32)
    found = np.sort(decode(v.astype(np.uint32)[:, None] ^ flips[None, :]).astype(np.int64), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found


@cache
def codewords() -> np.ndarray:
    """All 4096 codewords, by index."""
    i = np.arange(1 << 12, dtype=np.uint32) << CHECK
    low, high, _ = _tables()
    return i | (low[i & 0xFFF] ^ high[i >> 12])
