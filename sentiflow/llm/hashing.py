"""Vectorised 64-bit hashes: a bijective scramble, prefix polynomial hashes of bytes, words and word shingles."""

from __future__ import annotations

import numpy as np

from sentiflow.llm.common import WORD_BYTES


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PrefixHashes:
    """Polynomial hashes modulo 2**64 of all stretches of some bytes, from one running sum."""

    BASE = 0x9E3779B97F4A7C15
    _powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    def __init__(self, data: np.ndarray):
        power, self.inverse = self._tables(len(data) + 1)
        value = mixed(np.arange(1, 257, dtype=np.uint64))[data]
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(value * power[: len(data)], out=self.sums[1:])

    @classmethod
    def _tables(cls, n: int):
        if len(cls._powers[0]) < n:
            size = max(n, 1 << 20)
            made = []
            for base in (cls.BASE, pow(cls.BASE, -1, 1 << 64)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                made.append(np.multiply.accumulate(steps))
            cls._powers = tuple(made)
        return cls._powers

    def of(self, start, size) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.inverse[start]


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every lower-cased word of texts that lie one after another."""
    folded = np.frombuffer(data.tobytes().translate(WORD_BYTES), np.uint8)
    inside = np.concatenate([[False], folded != 32, [False]])
    text_edge = np.zeros(len(folded) + 1, bool)
    text_edge[off] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | text_edge[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | text_edge[1:])) + 1
    hashes = mixed(PrefixHashes(folded).of(start, end - start) + (end - start).astype(np.uint64))
    return hashes, np.searchsorted(off, start, side="right") - 1


def shingle_hashes(words: np.ndarray, row: np.ndarray, rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every ``size`` consecutive words of a text; a text of fewer words, but not none, is one shingle."""
    many = np.bincount(row, minlength=rows)
    first = np.cumsum(many) - many
    total = np.zeros(max(0, len(words) - size + 1), np.uint64)
    scale = mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    for i in range(size):
        total += words[i : i + len(total)] * scale[i]
    whole = np.flatnonzero(row[size - 1 :] == row[: len(total)]) if len(total) else np.zeros(0, np.int64)
    short = np.flatnonzero((many > 0) & (many < size))
    parts = [sum(int(w) * int(s) for w, s in zip(words[first[r] : first[r] + many[r]], scale)) % (1 << 64) for r in short]
    hashes = np.concatenate([mixed(total[whole]), mixed(np.array(parts, np.uint64) + many[short].astype(np.uint64))])
    return hashes, np.concatenate([row[whole], short])
