"""Vectorised scan of UTF-8 texts: tokens of many texts at once, as numpy arrays over their bytes.

A token is a maximal run of word bytes (letters, digits, all bytes from 0x80) or
of other visible bytes. Hashes are polynomial in the A-Z-lowered bytes, modulo 2^64.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SPACE, WORD, MARK = 0, 1, 2
KIND = np.full(256, MARK, np.uint8)
KIND[[0x20, *range(0x09, 0x0E)]] = SPACE
for _a, _b in (("0", "9"), ("A", "Z"), ("a", "z")):
    KIND[ord(_a): ord(_b) + 1] = WORD
KIND[0x80:] = WORD
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += 32
BASE = np.uint64(0x100000001B3)


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


POWERS = powers(1 << 12)


def mix(h: np.ndarray) -> np.ndarray:
    """Final avalanche of 64-bit hashes."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@dataclass
class Tokens:
    """Tokens of a run of texts, in order."""

    start: np.ndarray     # first byte
    size: np.ndarray      # bytes
    text: np.ndarray      # number of the text in the run
    kind: np.ndarray      # WORD or MARK
    hash: np.ndarray      # of the lowered bytes


def word_hash(word: str) -> np.uint64:
    """The hash that ``scan`` gives to a one-token word."""
    return scan(np.frombuffer(word.encode(), np.uint8), np.array([0, len(word.encode())])).hash[0]


def prefix_hash(vals: np.ndarray, start: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
    """Hashes of the first ``most`` bytes of each token (0 where it is shorter)."""
    out = np.zeros(len(start), np.uint64)
    long = np.flatnonzero(size >= most)
    for k in range(most):
        out[long] += vals[start[long] + k] * POWERS[k]
    out[long] = mix(out[long] + np.uint64(most))
    return out


def scan(data: np.ndarray, bounds: np.ndarray, kind_of: np.ndarray = KIND, lower: np.ndarray = LOWER) -> Tokens:
    """Tokens of the texts ``data[bounds[i]:bounds[i+1]]``; no token crosses texts."""
    kinds = kind_of[data]
    change = np.empty(len(data), bool)
    if len(data):
        change[0] = True
        change[1:] = kinds[1:] != kinds[:-1]
        inner = bounds[1:-1]
        change[inner[inner < len(data)]] = True
    starts = np.flatnonzero(change)
    size = np.diff(np.append(starts, len(data)))
    vals = lower[data]
    place = np.arange(len(data)) - np.repeat(starts, size)
    weight = POWERS[np.minimum(place, len(POWERS) - 1)] if len(data) and place.max() < len(POWERS) else powers(int(place.max()) + 1)[place] if len(data) else POWERS[:0]
    sums = np.add.reduceat(vals * weight, starts) if len(starts) else np.empty(0, np.uint64)
    keep = kinds[starts] != SPACE
    starts, size, sums = starts[keep], size[keep], sums[keep]
    return Tokens(starts, size, np.searchsorted(bounds, starts, "right") - 1, kinds[starts], mix(sums + size.astype(np.uint64)))
