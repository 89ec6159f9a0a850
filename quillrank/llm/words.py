"""Words of whole texts as numpy arrays, and fingerprints of words and of runs of words.

All word classes used here are sets of ASCII characters or everything beyond them, so words can be cut from the
UTF-8 bytes. Fingerprints have 64 bits; equal words always get equal ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21


def _blanks() -> np.ndarray:
    inside = np.ones(256, dtype=bool)
    inside[[0x20, *range(0x09, 0x0E)]] = False
    return inside


def _letters_digits() -> np.ndarray:
    inside = np.zeros(256, dtype=bool)
    inside[0x80:] = True
    inside[ord("0") : ord("9") + 1] = True
    inside[ord("a") : ord("z") + 1] = True
    return inside


BETWEEN_BLANKS = _blanks()  # [^\x20\x09-\x0D]+
LETTERS_DIGITS = _letters_digits()  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, for lower-cased texts
LOWERED_LETTERS_DIGITS = LETTERS_DIGITS.copy()  # the same words in texts that are not lower-cased
LOWERED_LETTERS_DIGITS[ord("A") : ord("Z") + 1] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = np.uint64(0x9E3779B97F4A7C13)
_RUN = np.uint64(0xD6E8FEB86659FD93)


def _inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 1 << 64))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(256, dtype=np.uint64), 7)


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: np.uint64, size: int) -> np.ndarray:
    """``base`` to the power of 0, 1, ... in 64 bits. Sizes are rounded up, so that few tables are kept."""
    return _powers(int(base), max(1 << 16, 1 << max(0, size - 1).bit_length()))[:size]


def _prefix_sums(values: np.ndarray, base: np.uint64) -> np.ndarray:
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    return sums


def _between(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64) -> np.ndarray:
    """Fingerprints of ``[start, end)``, independent of where it lies."""
    return mix((sums[end] - sums[start]) * powers(_inverse(base), len(sums))[start])


@dataclass(frozen=True)
class Words:
    """The words of some texts. Text i has the words ``first[i]`` to ``first[i + 1]``."""

    data: np.ndarray  # bytes of the texts
    start: np.ndarray  # of each word in ``data``
    end: np.ndarray
    first: np.ndarray
    bounds: np.ndarray  # of the texts in ``data``

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def fingerprints(self) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        return _between(_prefix_sums(_BYTE[self.data], _BASE), self.start, self.end, _BASE)

    def texts(self, which: np.ndarray) -> list[bytes]:
        """The words with these numbers."""
        data = self.data.tobytes()
        return [data[a:b] for a, b in zip(self.start[which].tolist(), self.end[which].tolist())]

    def run_starts(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words at which a run of ``n`` words of one text starts, and the texts."""
        runs = np.maximum(self.counts - n + 1, 0)
        return spans(self.first[:-1], runs), np.repeat(np.arange(len(runs)), runs)


def spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (length[0] numbers), start[1], ..."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    before = np.cumsum(length) - length
    return np.arange(total, dtype=np.int64) + np.repeat(start - before, length)


def run_fingerprints(words: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of the runs of ``n`` words that begin at ``start``, from the words' fingerprints."""
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    return _between(_prefix_sums(words, _RUN), start, start + n, _RUN)


def cut(column: pa.Array, lower: bool, inside: np.ndarray = BETWEEN_BLANKS) -> Words:
    """Words of a string column; null is an empty text."""
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    bounds = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    is_in = np.zeros(len(data) + 2, dtype=bool)
    is_in[1:-1] = inside[data]
    starts = is_in[1:-1] & ~is_in[:-2]
    ends = is_in[1:-1] & ~is_in[2:]
    filled = bounds[:-1][bounds[1:] > bounds[:-1]]  # words end where texts do
    starts[filled] = is_in[1:-1][filled]
    last = filled[1:] - 1
    ends[last] = is_in[1:-1][last]
    start = np.flatnonzero(starts)
    return Words(data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, bounds), bounds)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each holds about ``size`` bytes of text, or one longer text."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text).fill_null("")).to_numpy(zero_copy_only=False)
        below = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        low = 0
        while low < len(sizes):
            high = max(low + 1, int(np.searchsorted(below, below[low] + size, "right")) - 1)
            yield batch.slice(low, high - low)
            low = high
