"""Words and word n-grams of texts as 64-bit hashes, a batch of texts at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

_LOWER = {b: b + 32 for b in range(ord("A"), ord("Z") + 1)}
# Words are what bytes.split() leaves: runs without space, tab, line breaks, \v and \f.
SPACED = bytes(_LOWER.get(b, b) for b in range(256))
# Words are runs of digits, letters a-z and everything beyond ASCII.
ALNUM = bytes(
    _LOWER.get(b, b) if b > 127 or bytes([b]).isalnum() else 32 for b in range(256)
)
CACHED_WORDS = 100_000  # per Python worker; a full cache starts anew
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _Hashes()


def split_words(text: bytes | None, table: bytes) -> list[bytes]:
    return text.translate(table).split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive entries."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.full(count, n, np.uint64)
    for k in range(n):
        total = total * _MULTIPLIER + words[k : k + count]
    return mixed(total)


def hashed(texts: Iterable[bytes | None], table: bytes) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """(position, words, hashes of the words) of each text."""
    get = _HASHES.__getitem__
    for k, text in enumerate(texts):
        words = split_words(text, table)
        yield k, words, np.fromiter(map(get, words), np.uint64, len(words))


def as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """One Arrow list per array."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64) if flat.dtype == np.uint64 else flat, kind))


def small_batches(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, so that the lists made of very long texts stay small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
