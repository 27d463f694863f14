"""Benchmark decontamination with the multi-pattern search of Wu and Manber, over words.

Patterns are the windows of `window` consecutive words of the benchmark items; an item of fewer words is
one pattern. Patterns of one length share a table of shifts, indexed by a block of words: how far a
search may move on when it meets the block. A block that ends a pattern has shift 0; its hash selects
the patterns to compare, word by word, with the text. Many stretches of text are searched in step.

The benchmark is read in blocks of bounded size, so what is sent to the executors is bounded; more than
one block means as many passes over the documents. Words are compared by 64-bit fingerprints.

Null and empty texts have no words and no hits; items without words or without an id are left out, and
items that share an id count once. Repeated documents are judged one by one. Empty tables give no hits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.words import Words, mix, slices, words
from recordloom.scratch import written

_STRETCH = 512


def _block(previous: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mix(previous * np.uint64(0x9E3779B97F4A7C15) + last, 11)


class Patterns:
    """Patterns of one length with their shifts and suffix buckets."""

    def __init__(self, rows: np.ndarray):
        self.size = rows.shape[1]
        self.width = min(2, self.size)
        ends = [self._key(rows, j) for j in range(self.width - 1, self.size)]
        bits = max(16, int(len(rows) * len(ends) * 16).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.shift = np.full(1 << bits, min(self.size - self.width + 1, 255), dtype=np.uint8)
        for j, key in enumerate(ends):
            np.minimum.at(self.shift, key & self.mask, min(len(ends) - 1 - j, 255))
        order = np.argsort(ends[-1], kind="stable")
        self.suffix, self.order, self.rows = ends[-1][order], order, rows

    def _key(self, rows: np.ndarray, j: int) -> np.ndarray:
        return _block(rows[:, j - 1], rows[:, j]) if self.width == 2 else mix(rows[:, j], 11)

    def find(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """First word and number of the pattern of every occurrence."""
        counts = np.diff(w.first) - self.size + 1
        texts = np.flatnonzero(counts > 0)
        stretches = -(-counts[texts] // _STRETCH)
        part = np.arange(stretches.sum()) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        # The last word of the first and of the last window of each stretch.
        at = np.repeat(w.first[texts], stretches) + part * _STRETCH + self.size - 1
        stop = np.minimum(at + _STRETCH, np.repeat(w.first[texts + 1], stretches))
        found = []
        while len(at):
            key = _block(w.hashes[at - 1], w.hashes[at]) if self.width == 2 else mix(w.hashes[at], 11)
            step = self.shift[key & self.mask]
            here = step == 0
            if here.any():
                found.append((at[here], key[here]))
            at = at + np.maximum(step, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        ends, keys = (np.concatenate(x) for x in zip(*found, strict=True))
        low, high = np.searchsorted(self.suffix, keys, "left"), np.searchsorted(self.suffix, keys, "right")
        hit_at, hit_pattern = [], []
        for begin in range(0, len(ends), 1 << 16):
            lo, n = low[begin : begin + (1 << 16)], (high - low)[begin : begin + (1 << 16)]
            which = np.repeat(np.arange(len(n)), n)
            pattern = self.order[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            start = ends[begin : begin + (1 << 16)][which] - self.size + 1
            same = np.ones(len(start), dtype=bool)
            for j in range(self.size):
                same &= w.hashes[start + j] == self.rows[pattern, j]
            hit_at.append(start[same])
            hit_pattern.append(pattern[same])
        return np.concatenate(hit_at), np.concatenate(hit_pattern)


class Matcher:
    """The patterns of a block of items, and the items that each of them stands for."""

    def __init__(self, item_ids: list, texts: pa.Array, window: int):
        w = words(texts)
        counts = np.diff(w.first)
        self.by_size: list[tuple[Patterns, np.ndarray, np.ndarray]] = []
        ids = np.asarray(item_ids, dtype=np.int64)
        for size in np.unique(np.minimum(counts[counts > 0], window)).tolist():
            chosen = np.flatnonzero(counts >= window if size == window else counts == size)
            n = counts[chosen] - size + 1
            start = np.repeat(w.first[chosen] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            rows = w.hashes[start[:, None] + np.arange(size)]
            distinct, which = np.unique(rows, axis=0, return_inverse=True)
            order = np.argsort(which.reshape(-1), kind="stable")
            first = np.searchsorted(which.reshape(-1)[order], np.arange(len(distinct) + 1))
            self.by_size.append((Patterns(distinct), first, np.repeat(ids[chosen], n)[order]))

    def scan(self, texts: pa.Array) -> tuple[Words, np.ndarray, list[np.ndarray]]:
        """Words, whether each is hit, and for each text the sorted ids of the items found."""
        w = words(texts)
        edge = np.zeros(len(w.hashes) + 1, dtype=np.int64)
        owners, items = [], []
        for patterns, first, ids in self.by_size:
            start, pattern = patterns.find(w)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + patterns.size, -1)
            n = np.diff(first)[pattern]
            items.append(ids[np.repeat(first[pattern] - (np.cumsum(n) - n), n) + np.arange(n.sum())])
            owners.append(np.repeat(np.searchsorted(w.first, start, "right") - 1, n))
        found: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(texts)
        if owners:
            pairs = np.unique(np.stack([np.concatenate(owners), np.concatenate(items)], axis=1), axis=0)
            for rows in np.split(pairs, np.flatnonzero(np.diff(pairs[:, 0])) + 1) if len(pairs) else []:
                found[rows[0, 0]] = rows[:, 1]
        return w, np.cumsum(edge)[:-1] > 0, found


def _matchers(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Callable[[], Matcher]]:
    """The benchmark in blocks, each broadcast."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).dropna()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        table = block.toArrow()
        sent = benchmark.sparkSession.sparkContext.broadcast((table["item_id"].to_pylist(), table["text"].to_pylist()))
        yield _Lazy(sent, window)


class _Lazy:
    """Builds the matcher of a broadcast block once per task."""

    def __init__(self, sent, window: int):
        self.sent, self.window = sent, window

    def __call__(self) -> Matcher:
        ids, texts = self.sent.value
        return Matcher(ids, pa.array(texts, type=pa.string()), self.window)


_HITS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.LongType())),
    ]
)


def _edges(hit: np.ndarray) -> list[int]:
    return np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))).tolist()


def _merged(edges: list[int], more: list[int]) -> list[int]:
    """The union of two lists of [begin, end, begin, end, ...]."""
    out: list[int] = []
    for b, e in sorted([*zip(edges[::2], edges[1::2], strict=True), *zip(more[::2], more[1::2], strict=True)]):
        if out and b <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [b, e]
    return out


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 4 << 20) -> DataFrame:
    """(doc_id, text, n_words, hits, items): the hit runs of words as [begin, end, begin, end, ...] and the
    sorted ids of the items with an occurring window."""
    none = F.array().cast("array<long>")
    out = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        none.alias("hits"),
        none.alias("items"),
    )
    for k, matcher in enumerate(_matchers(benchmark, window, block_bytes)):
        if k:
            out = written(out, "decontaminate")

        def run(batches: Iterator[pa.RecordBatch], matcher=matcher, later=bool(k)) -> Iterator[pa.RecordBatch]:
            found = matcher()
            for batch in batches:
                for part in slices(batch, "text"):
                    w, hit, items = found.scan(part.column(1))
                    hits = [_edges(hit[a:b]) for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
                    items = [x.tolist() for x in items]
                    if later:
                        hits = [_merged(a, b) for a, b in zip(part.column(3).to_pylist(), hits, strict=True)]
                        items = [sorted({*a, *b}) for a, b in zip(part.column(4).to_pylist(), items, strict=True)]
                    longs = pa.list_(pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), pa.array(np.diff(w.first)), pa.array(hits, type=longs), pa.array(items, type=longs)],
                        names=_HITS.names,
                    )

        out = out.mapInArrow(run, _HITS)
    return out


def summary(found: DataFrame) -> DataFrame:
    """Counts and digests of what `contamination` found."""
    begins = F.filter("hits", lambda x, i: i % 2 == 0)
    ends = F.filter("hits", lambda x, i: i % 2 == 1)
    covered = F.aggregate(F.zip_with(begins, ends, lambda b, e: e - b), F.lit(0).cast("long"), lambda a, x: a + x)
    named = F.array_join(F.sort_array(F.col("items").cast("array<string>")), ",")
    return found.select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(named, 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def clean(documents: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 4 << 20) -> DataFrame:
    """The documents, all their columns, in which no window occurs."""
    out, at = documents, documents.columns.index("text")
    for matcher in _matchers(benchmark, window, block_bytes):

        def run(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            found = matcher()
            for batch in batches:
                for part in slices(batch, "text"):
                    w, hit, _ = found.scan(part.column(at))
                    hits = np.concatenate([[0], np.cumsum(hit)])[w.first]
                    yield part.filter(pa.array(np.diff(hits) == 0))

        out = out.mapInArrow(run, documents.schema)
    return out
