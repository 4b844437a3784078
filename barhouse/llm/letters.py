"""Words as runs of letters, found by array steps over whole chunks of texts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np

SPACE = 32
# Odd multipliers of the hashes below; any would do.
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


@cache
def _folded() -> np.ndarray:
    """For every code point its lower case, or a space if it is no letter."""
    table = np.full(0x110000, SPACE, np.uint32)
    for i in range(0x110000):
        if (c := chr(i)).isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


@dataclass(frozen=True)
class Words:
    """Letter runs of some texts, in order."""

    codes: np.ndarray  # code points; every word has a space before and after
    starts: np.ndarray  # of each word in codes
    lengths: np.ndarray
    counts: np.ndarray  # words of each text

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        return self.sums(self._mixed(np.arange(self.lengths.sum()) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)))

    def _places(self) -> np.ndarray:
        ends = np.cumsum(self.lengths)
        return np.repeat(self.starts - (ends - self.lengths), self.lengths) + np.arange(ends[-1] if len(ends) else 0)

    def _mixed(self, depth: np.ndarray) -> np.ndarray:
        x = (self.codes[self._places()].astype(np.uint64) + np.uint64(1)) * _MIX + depth.astype(np.uint64) * _STEP
        x ^= x >> np.uint64(29)
        x *= _STEP
        return x ^ (x >> np.uint64(32))

    def sums(self, per_letter: np.ndarray) -> np.ndarray:
        """Sum what there is per letter over each word."""
        if not len(self):
            return per_letter[:0]
        return np.add.reduceat(per_letter, np.cumsum(self.lengths) - self.lengths, axis=0)

    def grams(self, buckets: int, size: int = 3) -> np.ndarray:
        """A bucket per letter: of the ``size`` characters from the one before it, with spaces for those past the word."""
        at, ends = self._places(), np.repeat(self.starts + self.lengths, self.lengths)
        x = np.zeros(len(at), np.uint64)
        for k in range(size):
            x = (x ^ self.codes[np.minimum(at - 1 + k, ends)].astype(np.uint64)) * _MIX
            x ^= x >> np.uint64(31)
        return ((x * _STEP) >> np.uint64(40)).astype(np.int64) % buckets

    def take(self, rows: np.ndarray) -> Words:
        """Some of the words, as one text of their own."""
        part = Words(self.codes, self.starts[rows], self.lengths[rows], np.array([len(rows)]))
        lengths = part.lengths
        codes = np.full(int(lengths.sum()) + len(rows) + 1, SPACE, np.uint32)
        starts = 1 + np.cumsum(lengths + 1) - (lengths + 1)
        places = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        codes[places] = self.codes[part._places()]
        return Words(codes, starts, lengths, part.counts)


def words_of(texts: list[str | None]) -> Words:
    """Letter runs of whole texts in lower case; a null text has none."""
    joined = "\n".join(["", *(t or "" for t in texts), ""])
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _folded()[raw]
    letter = codes != SPACE
    edges = np.diff(letter.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    sizes = np.array([len(t or "") + 1 for t in texts], np.int64)
    counts = np.diff(np.searchsorted(starts, np.concatenate([[1], 1 + np.cumsum(sizes)])))
    return Words(codes, starts, ends - starts, counts)
