"""Periodic runs of words in a document, by maximal pairs of its LCP-interval tree, and texts with runs collapsed.

A run is a stretch with smallest period q, words q apart being identical, of at least `least` words and `times` * q,
that neither neighbour extends. Two suffixes q apart that agree on exactly L words and have different words before
them are a maximal pair; it covers the stretch of L + q words with period q, which nothing extends. So the maximal
pairs with L + q >= max(least, times * q) are the runs, each also with multiples of its period: the smallest stays.

Suffixes of the words, which are numbered exactly, are ranked by doubling until no two are equal; the ranks of
all lengths give the common prefixes of neighbours. The tree of LCP intervals is passed bottom-up. Each interval
holds the places below it, sorted, both all and by the word on their left. Where two children meet, each place of
the smaller looks for places of the larger at an allowed distance that have another word on the left, then the
smaller lists are merged into the larger ones. Only intervals deep enough for a run are built, and only documents in
which some sequence of that many words repeats are ranked at all; a hash chooses these, so that it can only add some.

Documents are judged one by one inside tasks; nothing is shuffled. Null and empty texts have no words and no runs.
Equal texts get equal results. A text of any length is taken whole, in memory of some 200 bytes per word if it
repeats itself. Among runs of equal exponent the first start counts, then the smallest period. Other columns are
not read, and an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.wordids import Numbered, number
from recordloom.llm.words import NOT_SPACE, UNCHANGED, mix, slices

#: (start, length, period), in words.
Run = tuple[int, int, int]


def depth(least: int, times: int) -> int:
    """The fewest words on which the two suffixes of a run's pair agree."""
    return min(max(least - q, (times - 1) * q) for q in range(1, least + 1))


def ranks(words: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks by the first 1, 2, 4, ... words, until all differ. `words` differ between documents, `ends` is where the
    document of each word ends."""
    n = len(words)
    levels = [np.append(np.unique(words, return_inverse=True)[1].astype(np.int64) + 1, 0)]
    width = 1
    while n and levels[-1].max() < n:
        here = levels[-1]
        later = np.arange(n) + width
        ahead = np.where(later < ends, here[np.minimum(later, n)], 0)
        levels.append(np.append(np.unique(here[:n] * (n + 1) + ahead, return_inverse=True)[1].astype(np.int64) + 1, 0))
        width *= 2
    return levels


def common_prefixes(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of words on which the suffixes at a and b agree; a and b differ."""
    n = len(levels[0]) - 1
    out = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = levels[k][np.minimum(a + out, n)], levels[k][np.minimum(b + out, n)]
        out += ((x == y) & (x > 0)).astype(np.int64) << k
    return out


class _Places:
    """Places below an interval: all in order, and in order by the word on their left."""

    __slots__ = ("all", "by_left")

    def __init__(self, place: int, left: int):
        self.all = [place]
        self.by_left = {left: [place]}


def _meet(a: _Places, b: _Places, left: list[int], agreed: int, least: int, times: int, found: Callable[[int, int, int], None]) -> _Places:
    """Report the maximal pairs between two children of an interval, then merge the children."""
    if len(a.all) < len(b.all):
        a, b = b, a
    far, near = agreed // (times - 1), max(1, least - agreed)
    if near <= far:
        for p in b.all:
            mine = left[p]
            low, high = bisect_left(a.all, p - far), bisect_right(a.all, p + far)
            if low == high:
                continue
            if high - low <= len(a.by_left):
                others = [a.all[low:high]]
            else:
                others = [v[bisect_left(v, p - far) : bisect_right(v, p + far)] for w, v in a.by_left.items() if w != mine]
            for places in others:
                for o in places:
                    if left[o] != mine and abs(o - p) >= near:
                        found(min(o, p), abs(o - p), agreed)
    for p in b.all:
        insort(a.all, p)
    for w, places in b.by_left.items():
        held = a.by_left.get(w)
        if held is None:
            a.by_left[w] = places
        elif len(held) < len(places):
            for p in held:
                insort(places, p)
            a.by_left[w] = places
        else:
            for p in places:
                insort(held, p)
    return a


def maximal_pairs(order: np.ndarray, agreed: np.ndarray, left: np.ndarray, least: int, times: int) -> dict[tuple[int, int], int]:
    """(start, end) -> smallest period, from suffixes in order and the words each shares with the one before."""
    out: dict[tuple[int, int], int] = {}

    def found(start: int, period: int, length: int) -> None:
        key = (start, start + length + period)
        out[key] = min(period, out.get(key, period))

    at = depth(least, times)
    deep = np.flatnonzero(agreed >= at)
    if not len(deep):
        return out
    before = left.tolist()
    cuts = np.flatnonzero(np.diff(deep) > 1) + 1
    for part in np.split(deep, cuts):
        low, high = int(part[0]) - 1, int(part[-1]) + 1
        places, shared = order[low:high].tolist(), agreed[low:high].tolist()
        open_intervals: list[tuple[int, _Places]] = []
        now = _Places(places[0], before[places[0]])
        for p, depth_here in zip(places[1:], shared[1:], strict=True):
            while open_intervals and open_intervals[-1][0] > depth_here:
                d, held = open_intervals.pop()
                now = _meet(held, now, before, d, least, times, found)
            if open_intervals and open_intervals[-1][0] == depth_here:
                d, held = open_intervals.pop()
                now = _meet(held, now, before, d, least, times, found)
            open_intervals.append((depth_here, now))
            now = _Places(p, before[p])
        while open_intervals:
            d, held = open_intervals.pop()
            now = _meet(held, now, before, d, least, times, found)
    return out


def _repeats(ids: np.ndarray, text_of: np.ndarray, size: int) -> np.ndarray:
    """Texts in which a sequence of `size` words may occur twice. Every text in which one does is among them."""
    if len(ids) <= size:
        return np.zeros(0, dtype=np.int64)
    h = np.zeros(len(ids) - size + 1, dtype=np.uint64)
    hashed = mix(ids.astype(np.uint64))
    for i in range(size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + hashed[i : len(ids) - size + 1 + i]
    inside = text_of[: len(h)] == text_of[size - 1 :]
    h, texts = mix(h[inside]) ^ mix(text_of[: len(h)][inside].astype(np.uint64), 9), text_of[: len(h)][inside]
    order = np.argsort(h)
    again = h[order][1:] == h[order][:-1]
    return np.unique(texts[order[1:][again]])


def find_runs(ids: np.ndarray, first: np.ndarray, least: int = 24, times: int = 3) -> dict[int, list[Run]]:
    """Text -> its runs by start, then period, for texts of numbered words that begin at `first`."""
    text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    chosen = _repeats(ids, text_of, depth(least, times))
    out: dict[int, list[Run]] = {}
    if not len(chosen):
        return out
    lengths = first[chosen + 1] - first[chosen]
    base = np.concatenate([[0], np.cumsum(lengths)])
    own = np.repeat(np.arange(len(chosen)), lengths)
    words = ids[np.arange(base[-1]) + np.repeat(first[chosen] - base[:-1], lengths)]
    # No word is shared by two documents.
    words = own * (int(ids.max()) + 1) + words
    levels = ranks(words, base[1:][own])
    order = np.argsort(levels[-1][:-1])
    agreed = np.zeros(len(order), dtype=np.int64)
    agreed[1:] = common_prefixes(levels, order[:-1], order[1:])
    # The first word of a document has none on its left.
    left = np.concatenate([[-1], levels[0][: len(words) - 1]])
    left[base[:-1]] = -1
    for (start, end), period in maximal_pairs(order, agreed, left, least, times).items():
        text = int(own[start])
        out.setdefault(int(chosen[text]), []).append((start - int(base[text]), end - start, period))
    for found in out.values():
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def _looped(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which word stands where in a document whose end is made to repeat: a tenth of the documents, by the checksum of
    the id; None for the others, and for those without an id or words."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


_FOUND = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField(
            "runs",
            T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])),
        ),
        T.StructField("collapsed", T.StringType()),
    ]
)
_RUNS = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))


def _joined(w: Numbered, chosen: np.ndarray) -> bytes:
    """Words, by place, with a space between them."""
    data, starts, ends = w.data, w.starts[chosen].tolist(), w.ends[chosen].tolist()
    raw = data.tobytes() if len(chosen) * 64 > len(data) else memoryview(data)
    return b" ".join([raw[s:e] for s, e in zip(starts, ends, strict=True)])


def collapse(documents: DataFrame, least: int = 24, times: int = 3, looped: bool = False, texts: bool = True) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the runs of each text, and its words without those that stand after the
    first period of a run, joined by single spaces. `looped` first makes a tenth of the documents repeat themselves.
    Without `texts`, `collapsed` is the SHA-256 of that text instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield _collapsed(part, least, times, looped, texts)

    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, _FOUND)


def _collapsed(part: pa.RecordBatch, least: int, times: int, looped: bool, texts: bool) -> pa.RecordBatch:
    w = number(part.column(1), NOT_SPACE, UNCHANGED)
    first, ids, doc_ids = w.first, w.ids.copy(), part.column(0).to_pylist()
    order = np.arange(len(ids))
    moved = set()
    for t, doc_id in enumerate(doc_ids if looped else ()):
        if (at := _looped(doc_id, int(first[t + 1] - first[t]))) is not None:
            order[first[t] : first[t + 1]] = first[t] + at
            ids[first[t] : first[t + 1]] = ids[first[t] + at]
            moved.add(t)
    runs = find_runs(ids, first, least, times)
    # Texts as they stand: the word bytes and one space after each word but the last.
    plain = np.zeros(len(w.data) + 1, dtype=bool)
    plain[w.ends] = True
    plain[w.ends[first[1:][np.diff(first) > 0] - 1]] = False
    plain[:-1] |= NOT_SPACE[w.data]
    spaced = np.append(w.data, np.uint8(0x20))
    spaced[w.ends] = np.where(plain[w.ends] & ~NOT_SPACE[spaced[w.ends]], 0x20, spaced[w.ends])
    out = []
    for t in range(len(doc_ids)):
        low, high = int(first[t]), int(first[t + 1])
        if t in moved or t in runs:
            edge = np.zeros(high - low + 1, dtype=np.int64)
            for start, length, period in runs.get(t, ()):
                edge[start + period] += 1
                edge[start + length] -= 1
            kept = _joined(w, order[low:high][np.cumsum(edge)[:-1] == 0])
        elif low == high:
            kept = b""
        else:
            a, b = int(w.starts[low]), int(w.ends[high - 1])
            kept = spaced[a:b][plain[a:b]].tobytes()
        out.append(kept if texts else hashlib.sha256(kept).hexdigest().encode())
    listed = [[{"start": s, "length": n, "period": q} for s, n, q in runs.get(t, ())] for t in range(len(doc_ids))]
    return pa.RecordBatch.from_arrays(
        [part.column(0), pa.array(np.diff(first)), pa.array(listed, type=_RUNS), pa.array(out, type=pa.binary()).cast(pa.string())],
        names=_FOUND.names,
    )


def summary(found: DataFrame) -> DataFrame:
    """Per document: the number of runs, the one of greatest exponent, and digests of all runs and of the kept words.
    `found` has digests instead of texts."""
    best = F.aggregate(
        "runs",
        F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        # Runs come by start, then period; a later one must be strictly better.
        lambda a, r: F.when(a.isNull() | (r.length * a.period > a.length * r.period), r).otherwise(a),
    )
    line = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
    )
