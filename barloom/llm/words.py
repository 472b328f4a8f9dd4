"""Words of whole texts and their hashes, vectorised over Arrow batches.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return in UTF-8,
that is ``[^\\x20\\x09-\\x0D]+``. Hashes are random polynomials modulo 2^64 followed by a mix of all bits: the
hash of a word is one over its bytes, the hash of a window one over its words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@dataclass
class Words:
    """Words of some documents: ``first[i]:first[i + 1]`` are those of document i of the slice."""

    rows: slice
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self, seed: int = 0) -> np.ndarray:
        if not len(self.starts):
            return np.empty(0, np.uint64)
        return self.range_hashes(self.starts, self.ends, seed)

    def range_hashes(self, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
        """Hashes of byte ranges of the slice."""
        return mix(_ranges(_table(seed)[self.data], starts, ends, seed))


def slices(texts: pa.Array) -> Iterator[Words]:
    """Whole documents in slices of about ``SLICE_BYTES``; a longer text is a slice of its own. NULL has no words."""
    texts = texts.cast(pa.large_string()).fill_null("") if texts.null_count else texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        last = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, row + 1), len(texts))
        yield split(data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row], slice(row, last))
        row = last


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def split(data: np.ndarray, offsets: np.ndarray, rows: slice) -> Words:
    inside = ~_SPACE[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    full = offsets[1:] > offsets[:-1]
    at, to = offsets[:-1][full], offsets[1:][full] - 1
    start[at], end[to] = inside[at], inside[to]
    starts = np.flatnonzero(start)
    return Words(rows, data, offsets, starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole word (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, starts: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``length`` hashes from each start on; the caller keeps starts within their document."""
    if not len(starts):
        return np.empty(0, np.uint64)
    return mix(_ranges(hashes, starts, starts + length, seed + 1000))


def full_starts(first: np.ndarray, length: int) -> np.ndarray:
    """Starts of all windows of ``length`` words that lie within one document."""
    n = np.diff(first)
    at = np.arange(first[-1] - first[0]) + first[0]
    return at[at + length <= np.repeat(first[1:], n)]


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    power, inverse = _powers(seed, len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * inverse[starts]


@cache
def _table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed + 77).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


_KNOWN_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(seed: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to ``size`` and their inverses; a worker keeps one pair a seed, as long as the longest yet asked for."""
    found = _KNOWN_POWERS.get(seed)
    if found is None or len(found[0]) <= size:
        base = int(np.random.default_rng(seed + 5).integers(2**61, 2**63)) | 3
        pair = []
        for factor in (base, pow(base, -1, 2**64)):
            steps = np.full((1 << max(16, size.bit_length())) + 1, factor, np.uint64)
            steps[0] = 1
            pair.append(np.multiply.accumulate(steps))
        found = _KNOWN_POWERS[seed] = (pair[0], pair[1])
    return found
