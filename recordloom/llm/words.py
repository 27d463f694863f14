"""Words of Arrow text batches as numpy arrays, without a Python object per word."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BLOCK = 1 << 20


def _class(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.ones(256, dtype=bool)
    for low, high in ranges:
        out[low : high + 1] = False
    return out


#: Bytes of a word when words end at ASCII white space.
NOT_SPACE = _class((0x20, 0x20), (0x09, 0x0D))
#: Bytes of a word when words are lower-cased ASCII letters, digits and everything beyond ASCII.
ALPHANUMERIC = _class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
UNCHANGED = np.arange(256, dtype=np.uint8)

#: Words of more bytes are hashed whole.
_LONG = 256
_RADIX = 0x9E3779B97F4A7C15 | 1


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit values."""
    h = h + U64((seed * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64), 7)


class _Powers:
    """Powers of the radix and of its inverse modulo 2^64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> _Powers:
        if len(self.up) < n:
            size = max(n, _BLOCK + 4096)
            steps = np.full(size, _RADIX, dtype=np.uint64)
            steps[0] = 1
            self.up = np.cumprod(steps, dtype=np.uint64)
            steps[1:] = pow(_RADIX, -1, 1 << 64)
            self.down = np.cumprod(steps, dtype=np.uint64)
        return self


_POWERS = _Powers()


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i], times the inverse power i, the hash of bytes i to j."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUE[data] * _POWERS.upto(len(data)).up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return (prefix[ends] - prefix[starts]) * _POWERS.upto(len(prefix)).down[starts]


@dataclass
class Words:
    """Words in order: byte ranges in `data`, hashes, and for each text its first word (one more at the end)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array and its offsets from 0; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def runs(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray, single: int = -1) -> Words:
    """The maximal runs of bytes of one class inside each text. Class 0 is left out; a byte of class
    `single` is a run of its own."""
    texts = np.unique(offsets)
    found = []
    low = 0
    while low < len(data):
        high = min(low + _BLOCK, len(data))
        # A block ends where no run goes on: where the class changes, or where a text ends.
        while high < len(data) and classes[high] and classes[high] == classes[high - 1]:
            ahead = classes[high : high + 4096]
            stop = np.flatnonzero(ahead != classes[high - 1])
            step = int(stop[0]) if len(stop) else len(ahead)
            i = np.searchsorted(texts, high)
            if i < len(texts) and texts[i] <= high + step:
                high = int(texts[i])
                break
            high += step
        block, kind = data[low:high], classes[low:high]
        changes = np.ones(len(block) + 1, dtype=bool)
        changes[1:-1] = kind[1:] != kind[:-1]
        if single >= 0:
            changes[:-1] |= kind == single
        changes[texts[np.searchsorted(texts, low) : np.searchsorted(texts, high)] - low] = True
        cuts = np.flatnonzero(changes)
        inside = kind[cuts[:-1]] != 0
        s, e = cuts[:-1][inside], cuts[1:][inside]
        found.append((s + low, e + low, span_hash(prefix_hash(block), s, e)))
        low = high
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return Words(data, none, none, none.astype(np.uint64), np.zeros(len(offsets), dtype=np.int64))
    starts, ends, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
    # Some pairs of long words have equal sums for every odd radix.
    for i in np.flatnonzero(ends - starts > _LONG):
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return Words(data, starts, ends, mix(hashes), np.searchsorted(starts, offsets).astype(np.int64))


def split(data: np.ndarray, offsets: np.ndarray, kept: np.ndarray, table: np.ndarray = LOWER) -> Words:
    """The maximal runs of kept bytes of each text, after `table` has been applied."""
    data = table[data]
    return runs(data, offsets, kept.astype(np.uint8)[data])


def words(texts: pa.Array, kept: np.ndarray = ALPHANUMERIC, table: np.ndarray = LOWER) -> Words:
    return split(*buffer(texts), kept, table)


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, cut where the column's bytes pass `limit`; a longer text comes alone."""
    _, offsets = buffer(batch.column(batch.schema.get_field_index(column)))
    low = 0
    while low < len(batch):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1)
        yield batch.slice(low, high - low)
        low = high


def give_back() -> None:
    """Hand memory that is no longer used back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run` for `mapInArrow`, giving memory back at the end: Spark keeps workers, and what they hold, for later stages."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return each


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words inside a text, their first words, and for each text the index
    of its first run (one more at the end)."""
    counts = np.maximum(np.diff(w.first) - size + 1, 0)
    firsts = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(firsts[-1]) + np.repeat(w.first[:-1] - firsts[:-1], counts)
    out = np.zeros(len(at), dtype=np.uint64)
    for i in range(size):
        out = mix(out * U64(_RADIX) + w.hashes[at + i], 1)
    return out, at, firsts
