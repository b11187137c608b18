"""Ids of texts from ids of their words, with a table of the words seen so far.

Words are byte spans of many texts at once. Their 64-bit hashes are looked up in
sorted runs; only words not seen before are encoded. When the table holds more than ``most`` words,
those that were met only once are forgotten (all, if most of them were met again), so memory is bounded
whatever the vocabulary and frequent words stay.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash

from .textscan import POWERS, mix

LONG = 64
#: bytes (``LONG`` at least) whose spans are hashed at once: the work arrays take 40 times as many
BLOCK = 1 << 16


def span_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """Hashes of adjacent spans of ``data`` after mapping bytes by ``fold``."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + BLOCK)))
        if sizes[to - 1] >= BLOCK:      # a long span is hashed below
            to = max(at, to - 1)
        if to == at:
            at += 1
            continue
        first, n = starts[at:to] - starts[at], sizes[at:to]
        place = np.arange(n.sum()) - np.repeat(first, n)
        vals = fold[data[starts[at]: starts[at] + n.sum()]] * POWERS[np.minimum(place, LONG)]
        out[at:to] = mix(np.add.reduceat(vals, first) + n.astype(np.uint64))
        at = to
    folded = fold.astype(np.uint8)
    for i in np.flatnonzero(sizes >= LONG):  # polynomial hashes of long spans are weaker
        out[i] = xxhash.xxh64_intdigest(folded[data[starts[i]: starts[i] + sizes[i]]].tobytes(), 1)
    return out


class WordTable:
    def __init__(self, encode: Callable[[list[str]], list[np.ndarray]], most: int = 600_000):
        self.encode, self.most = encode, most
        self.clear()

    def clear(self) -> None:
        self.runs: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []   # sorted hashes, first id, number of ids, whether met again
        self.ids = np.empty(0, np.int32)

    def __len__(self) -> int:
        return sum(len(r[0]) for r in self.runs)

    def _merge(self) -> tuple[np.ndarray, ...]:
        """All runs as one."""
        whole = [np.concatenate(c) for c in zip(*self.runs)]
        order = np.argsort(whole[0])
        self.runs = [tuple(c[order] for c in whole)]
        return self.runs[0]

    def _forget(self) -> None:
        """Keep the words met again since they came or were last kept."""
        h, s, n, again = self._merge()
        if 2 * np.count_nonzero(again) > self.most:
            self.clear()
            return
        h, s, n = h[again], s[again], n[again]
        start = np.cumsum(n) - n
        self.ids = self.ids[np.repeat(s - start, n) + np.arange(n.sum())]
        self.runs = [(h, start, n, np.zeros(len(h), bool))] if len(h) else []

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        start, count, known = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        for h, s, n, again in self.runs:
            todo = np.flatnonzero(~known)
            at = np.minimum(np.searchsorted(h, keys[todo]), len(h) - 1)
            hit = h[at] == keys[todo]
            todo, at = todo[hit], at[hit]
            start[todo], count[todo], known[todo] = s[at], n[at], True
            again[at] = True
        return start, count, known

    def _add(self, keys: np.ndarray, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        count = np.array([len(i) for i in ids], np.int64)
        start = len(self.ids) + np.concatenate(([0], np.cumsum(count)[:-1]))
        self.ids = np.concatenate([self.ids, *ids]).astype(np.int32, copy=False)
        self.runs.append((keys, start, count, np.zeros(len(keys), bool)))   # keys come sorted from unique()
        if len(self.runs) > 6:
            self._merge()
        return start, count

    def __call__(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, number of ids up to each word) of adjacent spans that cover ``data``."""
        if not len(starts):
            return np.empty(0, np.int32), np.zeros(1, np.int64)
        if len(self) > self.most:
            self._forget()
        keys, first, back = np.unique(span_hashes(data, starts, sizes, fold), return_index=True, return_inverse=True)
        start, count, known = self._find(keys)
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            words = [raw[a:b].decode() for a, b in zip(starts[first[new]].tolist(), (starts[first[new]] + sizes[first[new]]).tolist())]
            start[new], count[new] = self._add(keys[new], self.encode(words))
        n = count[back]
        ends = np.concatenate(([0], np.cumsum(n)))
        return self.ids[np.repeat(start[back] - ends[:-1], n) + np.arange(ends[-1])], ends
