"""Word shingles of whole texts as 64-bit hashes, for Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SHINGLE_WORDS = 5

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = (x ^ (x >> _HALF)) * _MIX
    x = (x ^ (x >> _HALF)) * _MIX
    return x ^ (x >> _HALF)


class WordHashes(dict):
    """64-bit hashes of words, remembered; emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 1 << 20):
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: bytes, hashes: WordHashes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; A-Z lower-cased.

    Words are separated by space, tab, line feed, vertical tab, form feed and carriage
    return. A text of fewer words, but not none, has one shingle: all of them.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    many = len(words) - width + 1
    runs = h[:many].copy()
    for k in range(1, width):
        runs *= _MULTIPLIER
        runs += h[k : k + many]
    return np.unique(mixed(runs + np.uint64(width)))


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; NULL is empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def small_batches(
    batches: Iterator[pa.RecordBatch], text: str, most: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text, one row at least."""
    for batch in batches:
        lengths = np.array(
            [n or 0 for n in pc.binary_length(batch.column(text)).to_pylist()], np.int64
        )
        starts, total = [0], 0
        for i, n in enumerate(lengths):
            if total and total + n > most:
                starts.append(i)
                total = 0
            total += n
        for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            if end > start:
                yield batch.slice(start, end - start)
