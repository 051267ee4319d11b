"""Words of many texts at once: positions and 64-bit hashes by array arithmetic, without a loop over words.

A word is a maximal run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return. These
bytes never occur inside a longer UTF-8 character, so the bytes give the same words as the characters.
"""

from __future__ import annotations

import numpy as np

_ODD, _STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1
#: Longer tables of powers, for very long texts, are made anew each time and not kept.
_KEPT_POWERS = 1 << 19
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUE = np.random.default_rng(20240611).integers(1, 1 << 63, 256, np.int64).astype(np.uint64) | np.uint64(1)
_LOWER_VALUE = _VALUE.copy()
_LOWER_VALUE[65:91] = _VALUE[97:123]


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least ``n`` of each."""
    held = _tables.get(base)
    if held is None or len(held[0]) < n:
        size = 1 << max(16, int(n).bit_length())
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        held = (out[0], out[1])
        if size <= _KEPT_POWERS:
            _tables[base] = held
    return held


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``.

    ``starts`` and ``ends`` are byte positions, ``first[i]:first[i + 1]`` are the words of text i, ``hashes`` their
    hashes (with ``lower``, A-Z count as a-z).
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        inside = ~SPACE[data]
        n = len(data)
        begin, end = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
        begin[:n] = inside
        begin[1:n] &= ~inside[: n - 1]
        end[1:] = inside
        end[1:n] &= ~inside[1:]
        cuts = offsets[(offsets > 0) & (offsets < n)]
        begin[cuts] = inside[cuts]
        end[cuts] = inside[cuts - 1]
        self.starts, self.ends = np.flatnonzero(begin[:n]), np.flatnonzero(end)
        self.first = np.searchsorted(self.starts, offsets)
        power, inverse = _powers(_ODD, n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((_LOWER_VALUE if lower else _VALUE)[data] * power[:n], out=total[1:])
        self._total = total
        length = (self.ends - self.starts).astype(np.uint64)
        self.hashes = mixed((total[self.ends] - total[self.starts]) * inverse[self.starts] + length)
        self._sums: np.ndarray | None = None

    def totals(self) -> np.ndarray:
        """Running sums from which the hash of any bytes follows: (total[end] - total[start]) / base ** start."""
        return self._total

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the word sequences ``start[i]:end[i]``; equal sequences have equal hashes wherever they stand."""
        n = len(self.hashes)
        power, inverse = _powers(_STEP, n + 1)
        if self._sums is None:
            self._sums = np.zeros(n + 1, np.uint64)
            np.cumsum(self.hashes * power[:n], out=self._sums[1:])
        length = np.asarray(end - start).astype(np.uint64)
        return mixed((self._sums[end] - self._sums[start]) * inverse[start] + length * np.uint64(_ODD))

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, first) of all runs of ``k`` words inside one text; ``first`` counts windows by text as for words."""
        counts = np.maximum(np.diff(self.first) - k + 1, 0)
        first = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=first[1:])
        start = np.arange(first[-1]) + np.repeat(self.first[:-1] - first[:-1], counts)
        return start, first
