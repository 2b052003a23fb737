"""Words of whole texts as numpy arrays, for use inside Arrow batches.

A word is a run of bytes other than \\x20 and \\x09-\\x0D. These are single bytes in UTF-8, so words are
found byte by byte. A null text has no words. Texts are taken in chunks of about `CHUNK` bytes, at
least one whole text each, so memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 18
CHUNK_TEXTS = 1024

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BASE = 0x9E3779B97F4A7C15
BYTE_VALUES = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64) * 2 + 1


class Chunk(NamedTuple):
    """Texts `first` to `last` - 1 of a batch: their bytes, and where each begins and ends in them."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


class Words(NamedTuple):
    """Where the words of a chunk begin and end in its bytes; words bounds[i]:bounds[i + 1] are text i's."""

    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    def text_of_each(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[Chunk]:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if not len(texts):
        return
    _, where, data = texts.buffers()
    where = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(where, where[first] + size, "right")) - 1)
        last = min(last, first + CHUNK_TEXTS)
        low, high = where[first], where[last]
        yield Chunk(first, last, data[low:high], where[first : last + 1] - low)
        first = last


def find_words(data: np.ndarray, bounds: np.ndarray) -> Words:
    inside = ~SPACES[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    begins[edges] |= inside[edges]
    ends[edges - 1] |= inside[edges - 1]
    start = np.flatnonzero(begins)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, bounds))


def scramble(values: np.ndarray) -> np.ndarray:
    """64-bit values spread evenly, one to one."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def _all_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(BASE, -1, 2**64)
    both = []
    for base in (BASE, inverse):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        both.append(np.cumprod(steps, dtype=np.uint64))
    return both[0], both[1]


@lru_cache(maxsize=1)
def _usual_powers() -> tuple[np.ndarray, np.ndarray]:
    return _all_powers(2 * CHUNK)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of a chunk of many texts are kept; those of one very long text go with it."""
    return _usual_powers() if n <= 2 * CHUNK else _all_powers(n)


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of `values` (odd 64-bit numbers that stand for its symbols)."""
    up, down = _powers(1 << max(int(len(values)).bit_length(), 18))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return scramble((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    return span_hashes(BYTE_VALUES[data], words.start, words.end)


def sums_by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values[bounds[i]:bounds[i + 1]] for each i; zero for none."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def code_points(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """The chunk's code points, and where each text begins and ends among them."""
    points = np.frombuffer(chunk.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    before = np.zeros(len(chunk.data) + 1, np.int64)
    np.cumsum((chunk.data & 0xC0) != 0x80, out=before[1:])
    return points, before[chunk.bounds]


@lru_cache(maxsize=1)
def lower_points() -> np.ndarray:
    """The lower-case code point of each code point, where that is a single one; others stay."""
    table = np.arange(0x110000, dtype=np.uint32)
    for point in range(0x1E944):
        low = chr(point).lower()
        if len(low) == 1:
            table[point] = ord(low)
    return table
