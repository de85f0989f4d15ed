"""Shingle sets of whole texts as sorted arrays of 64-bit hashes, made in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

from .common import sliced

CACHED_WORDS = 200_000  # word hashes that a worker remembers before it starts anew (memory only, no effect on results)
PARITY_WORDS = 16  # 64-bit words of a set's bitmap
_P = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word -> 64-bit hash, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: bytes | None, k: int, seen: WordHashes) -> np.ndarray:
    """Distinct k-word shingles of the A-Z-lowered text, as ascending signed hashes. Words are runs of anything but the
    ASCII white space; a text of fewer words is one shingle of all its words; without words the set is empty."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
    span = min(k, len(words))
    rolled = np.full(len(h) - span + 1, np.uint64(span))
    for j in range(span):
        rolled = rolled * _P + h[j:len(h) - span + 1 + j]
    return np.unique(_finish(rolled).view(np.int64))


def digest(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def list_column(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(p) for p in parts], dtype=np.int32)
    values = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int64()))


def prefix_batches(k: int, width: Callable[[int], int]) -> Callable:
    """Arrow batches (doc_id, text as binary) -> (doc_id, n, digest, prefix): the ``width(n)`` smallest hashes of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()
        for batch in (part for whole in batches for part in sliced(whole, "text")):
            sets = [shingle_set(t, k, seen) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([digest(s) for s in sets], pa.binary()),
                 list_column([s[:width(len(s))] for s in sets])], names=["doc_id", "n", "digest", "prefix"])

    return run


def parity(tokens: np.ndarray) -> np.ndarray:
    """Bitmap of a set: each token turns one of 64 * ``PARITY_WORDS`` bits. Two sets differ in at least as many tokens as their
    bitmaps differ in bits."""
    odd = np.bincount(tokens & (64 * PARITY_WORDS - 1), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def set_batches(k: int) -> Callable:
    """Arrow batches (text as binary) -> (digest, tokens, parity): the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()
        for batch in (part for whole in batches for part in sliced(whole, "text")):
            sets = [shingle_set(t, k, seen) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([digest(s) for s in sets], pa.binary()), list_column(sets), list_column([parity(s) for s in sets])],
                                             names=["digest", "tokens", "parity"])

    return run


def digest_batches(k: int) -> Callable:
    """Arrow batches with ``text_`` as binary -> the same with the digest of the set of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()
        for batch in (part for whole in batches for part in sliced(whole, "text_")):
            made = [digest(shingle_set(t, k, seen)) for t in batch.column("text_").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*batch.schema.names, "digest_"])

    return run
