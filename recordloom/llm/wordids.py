"""Word numbers of Arrow text batches: two words of a batch have one number exactly where their bytes are equal."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from recordloom.llm.words import buffer


@dataclass
class Numbered:
    """Words in order: byte ranges in `data`, numbers, the distinct words by number, and for each text its
    first word (one more at the end)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    ids: np.ndarray
    distinct: pa.Array
    first: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def from_bytes(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    """A string array over given bytes."""
    wide = len(data) >= 1 << 31
    at = np.ascontiguousarray(offsets, dtype=np.int64 if wide else np.int32)
    return pa.Array.from_buffers(
        pa.large_string() if wide else pa.string(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))]
    )


def number(texts: pa.Array, kept: np.ndarray, table: np.ndarray) -> Numbered:
    """The maximal runs of `kept` bytes inside each text, after `table` has been applied; null is empty."""
    raw, offsets = buffer(texts)
    data = table[raw]
    inside = kept[data]
    # A word begins where the byte before is outside, or where a text begins.
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    bounds = offsets[:-1][offsets[:-1] < offsets[1:]]
    begin[bounds] = inside[bounds]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    end[last] = inside[last]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    at = np.concatenate([[0], np.cumsum(ends - starts)])
    coded = from_bytes(at, data[inside]).dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Numbered(data, starts, ends, ids, coded.dictionary, np.searchsorted(starts, offsets))


def tally(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and how often each occurs."""
    found = pa.array(keys).value_counts()
    return found.field(0).to_numpy(), found.field(1).to_numpy()


def grouped(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in batches of about `limit` bytes of the column, so that small batches share one tally."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        _, offsets = buffer(batch.column(column))
        low = 0
        while low < len(batch):
            high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit - size, side="right")) - 1)
            held.append(batch.slice(low, high - low))
            size += int(offsets[high] - offsets[low])
            low = high
            if size >= limit:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
        if len(held) > 64:
            held = pa.Table.from_batches(held).combine_chunks().to_batches()
    if held and (rest := pa.Table.from_batches(held).combine_chunks().to_batches()):
        yield rest[0]
