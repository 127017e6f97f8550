"""Words and hashed word shingles of whole texts, for use inside Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

from mailshape.llm.memos import alone

SHINGLE_WORDS = 5
_MEMO = 150_000
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.array([pow(_BASE, k, 1 << 64) for k in range(SHINGLE_WORDS)], dtype=np.uint64)


class _WordHashes(dict):
    """Memo of 64-bit word hashes, emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) < 64:
            self[word] = value
        return value


_hashes = _WordHashes()


def slices(batches: Iterable[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    """Short runs of rows, so that what is made of a run's long texts stays small."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def words(text: str | None) -> list[bytes]:
    """Runs without ASCII white space, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(alone(_hashes).__getitem__, found), dtype=np.uint64, count=len(found))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits of a sum of products are of use."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all 5-word shingles; of fewer words the whole sequence is
    one shingle; without words the set is empty."""
    hashes = word_hashes(words(text))
    n = len(hashes)
    width = min(n, SHINGLE_WORDS)
    if not n:
        return hashes
    rolled = np.zeros(n - width + 1, dtype=np.uint64)
    for k in range(width):
        rolled += hashes[k:n - width + 1 + k] * _POWERS[k]
    return np.unique(mixed(rolled + np.uint64(width)))
