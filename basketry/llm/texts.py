"""Helpers shared by the Arrow functions: byte-bounded chunks and word splits.

Words are runs of ASCII letters and digits and of non-ASCII characters after
A-Z became a-z. On UTF-8 bytes that is one table lookup: every byte of a
non-ASCII character is >= 0x80 and stays, every other separator becomes a
space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Bytes of text handled at once inside a task; a longer row is a chunk alone.
CHUNK_BYTES = 1 << 20

_WORD_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256))


def chunks(batches, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows whose ``column`` holds about ``limit`` bytes at most."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, base + limit, side="right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every value; null counts as empty."""
    return [b"" if b is None else b for b in column.cast(pa.binary()).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """Lower-cased words of a UTF-8 text."""
    return text.translate(_WORD_TABLE).split()


class WordHashes(dict):
    """64-bit hash of a word, remembered for the words seen first."""

    KEPT = 1 << 16

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.KEPT:
            self[word] = value
        return value

    def of(self, items: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, items), np.uint64, len(items))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (multiply, xor-shift rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
