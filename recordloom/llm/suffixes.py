"""Removal of repeated byte strings by two-stage suffix sorting.

A string of `length` bytes that starts anywhere else too, in the same text or another, is repeated, and all
bytes it covers are removed.

1. Every window of `length` bytes is named by its anchor, the string of `anchor` bytes in it with the smallest
   hash. Neighbouring windows share an anchor, and equal windows have equal anchors at equal places, so the
   stretch of text that the windows of one anchor cover is the unit of work. Anchors that occur once are dropped
   by one aggregate. Stretches that occur twice as a whole are repeated as a whole.
2. Different stretches of one anchor are gathered, each content once, and their suffixes sorted in two stages
   (Itoh and Tanaka): only suffixes smaller than their successors are sorted directly, the others follow from
   scans of the buckets of first bytes in order. Common prefixes of adjacent suffixes give the repeats.
3. Anchors with very many different stretches are sorted in chunks; classes of equal windows of different
   chunks then meet by ranges of their hashes.

Texts are UTF-8 bytes, matches never cross texts, and null counts as empty. Repeated rows are repeats of each
other. Rows without an id are treated like any others. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.linear import lists
from recordloom.llm.words import buffer, mix, prefix_hash, slices, span_hash
from recordloom.scratch import written

LENGTH, ANCHOR = 200, 64


def _window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each `width` consecutive keys."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def stretches(texts: pa.Array, length: int = LENGTH, anchor: int = ANCHOR) -> dict[str, np.ndarray]:
    """The anchors of all texts: number of the text, first byte and size of the stretch that the anchor's
    windows cover, hash of the anchor and of the stretch."""
    data, offsets = buffer(texts)
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return {"text": none, "start": none, "size": none, "anchor": none, "content": none}
    prefix = prefix_hash(data)
    at = np.arange(len(data) - anchor + 1)
    grams = mix(span_hash(prefix, at, at + anchor), 41)
    # The place in the low bits lets the first of equal hashes win.
    bits = np.uint64(max(24, int(len(data)).bit_length()))
    keys = (grams >> bits << bits) | at.astype(np.uint64)
    place = (_window_minima(keys, length - anchor + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(sizes)), sizes)[: len(place)]
    real = np.arange(len(place)) + length <= offsets[1:][owner]
    begins = real.copy()
    begins[1:] &= (place[1:] != place[:-1]) | (owner[1:] != owner[:-1]) | ~real[:-1]
    first = np.flatnonzero(begins)
    ends = np.zeros(len(real), dtype=bool)
    ends[:-1] = real[:-1] & (begins[1:] | ~real[1:])
    ends[-1] = real[-1]
    stop = np.flatnonzero(ends) + length
    whole = mix(span_hash(prefix, first, stop), 42)
    text = owner[first]
    return {"text": text, "start": first - offsets[:-1][text], "size": stop - first, "anchor": grams[place[first]].view(np.int64), "content": whole.view(np.int64)}


def _words(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as a number that sorts like them; beyond the end there are zeros."""
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text), dtype=np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(text)]
    return out


def _sorted_directly(places: np.ndarray, ranks: np.ndarray, depth: int) -> np.ndarray:
    """`places` in the order of their suffixes to at least `depth` bytes. `ranks` orders 8 bytes at a time."""
    order = places[np.argsort(ranks[places], kind="stable")]
    first = ranks[order]
    group = np.concatenate([[0], np.cumsum(first[1:] != first[:-1])]) if len(order) else first.astype(np.int64)
    padded = np.concatenate([ranks, np.zeros(depth + 8, dtype=ranks.dtype)])
    for step in range(8, depth, 8):
        tied = np.zeros(len(order), dtype=bool)
        tied[1:] = group[1:] == group[:-1]
        tied[:-1] |= tied[1:]
        open_ = np.flatnonzero(tied)
        if not len(open_):
            break
        some = order[open_]
        key = (group[open_].astype(np.uint64) << np.uint64(32)) | padded[some + step].astype(np.uint64)
        by = np.argsort(key, kind="stable")
        order[open_], key = some[by], key[by]
        # Groups keep the number of their first member's place, so numbers stay in order.
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        group[open_] = open_[np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))]
        closed = ~tied
        group[closed] = np.flatnonzero(closed)
    return order


def suffix_array(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Places of `text` in the order of their suffixes, to a depth of at least `depth` bytes."""
    n = len(text)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    run_first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    run_size = np.diff(np.append(run_first, n))
    value = text[run_first].astype(np.int64)
    rises = np.append(value[1:] > value[:-1], False)
    smaller = np.repeat(rises, run_size)  # smaller than its successor; nothing follows the last
    _, ranks = np.unique(_words(text), return_inverse=True)
    direct = _sorted_directly(np.flatnonzero(smaller), ranks.astype(np.uint32), depth)
    cuts = np.searchsorted(text[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[text[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        bucket = []
        # Each scan yields the predecessors that begin with the same byte, which stand in the same bucket.
        layer = np.concatenate(induced[c]) if induced[c] else np.zeros(0, dtype=np.int64)
        while len(layer):
            bucket.append(layer)
            before = layer[layer > 0] - 1
            layer = before[text[before] == c]
        bucket.append(direct[cuts[c] : cuts[c + 1]])
        block = np.concatenate(bucket)
        out.append(block)
        before = block[block > 0] - 1
        before = before[text[before] > c]
        heads = text[before]
        by = np.argsort(heads, kind="stable")
        before, heads = before[by], heads[by]
        edges = np.flatnonzero(np.concatenate([[True], heads[1:] != heads[:-1]])) if len(heads) else []
        for part in np.split(before, edges[1:]) if len(heads) else []:
            induced[text[part[0]]].append(part)
    return np.concatenate(out)


def classes(text: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """The windows at `starts` in suffix order, and the number of the class of equal windows of each."""
    wanted = np.zeros(len(text), dtype=bool)
    wanted[starts] = True
    order = suffix_array(text, length)
    order = order[wanted[order]]
    words = np.concatenate([_words(text), np.zeros(length, dtype=np.uint64)])
    same = np.ones(max(len(order) - 1, 0), dtype=bool)
    steps = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]
    for step in steps:
        here = np.flatnonzero(same)
        same[here] = words[order[here] + step] == words[order[here + 1] + step]
    return order, np.concatenate([[0], np.cumsum(~same)]) if len(order) else order


def _texts(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("t"), F.octet_length(text).alias("n"))


def _anchors(documents: DataFrame, length: int, anchor: int) -> DataFrame:
    """(t, n, start, size, anchor, content) of all stretches; t and n stand for the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                s = stretches(part.column(0), length, anchor)
                text = s.pop("text")
                names = {"t": part.column(1).to_numpy()[text], "n": part.column(2).to_numpy()[text]}
                yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in (names | {"start": s["start"].astype(np.int32), "size": s["size"].astype(np.int32), "anchor": s["anchor"], "content": s["content"]}).items()})

    return _texts(documents).where(F.col("n") >= length).select("text", "t", "n").mapInArrow(run, "t long, n int, start int, size int, anchor long, content long")


def _sorted_stretches(pieces: DataFrame, length: int, batch_bytes: int) -> DataFrame:
    """From (anchor, chunk, chunks, content, bytes): (anchor, content, edges) for stretches that hold repeated
    windows, and for anchors with several chunks (anchor, range, hashes, contents, places) of window classes."""

    def sort(rows: list[tuple]) -> pa.RecordBatch:
        text = np.frombuffer(b"".join(r[4] for r in rows), dtype=np.uint8)
        first = np.concatenate([[0], np.cumsum([len(r[4]) for r in rows])])
        windows = np.diff(first) - length + 1
        owner = np.repeat(np.arange(len(rows)), windows)
        starts = np.arange(windows.sum()) + np.repeat(first[:-1] - (np.cumsum(windows) - windows), windows)
        order, number = classes(text, starts, length)
        uses = np.bincount(number)
        repeated = np.zeros(len(text) + 1, dtype=bool)
        repeated[order[uses[number] > 1]] = True
        out: list[tuple] = []
        for i, r in enumerate(rows):
            edges = _edges(repeated[first[i] : first[i] + windows[i]], length)
            if edges:
                out.append((r[0], r[3], edges, None, None, None, None))
        chunked = np.array([r[2] > 1 for r in rows])
        if chunked.any():
            prefix = prefix_hash(text)
            lead = order[np.concatenate([[True], number[1:] != number[:-1]])]
            piece = np.searchsorted(first, lead, "right") - 1
            lead, piece = lead[chunked[piece]], piece[chunked[piece]]
            hashes = mix(span_hash(prefix, lead, lead + length), 43)
            parts = np.array([r[2] for r in rows], dtype=np.uint64)[piece]
            anchors = np.array([r[0] for r in rows])[piece]
            ranges = (hashes % parts).astype(np.int64)
            contents = np.array([r[3] for r in rows])[piece]
            by = np.lexsort((ranges, anchors))
            cut = np.flatnonzero((np.diff(ranges[by]) != 0) | (np.diff(anchors[by]) != 0)) + 1
            for g in np.split(by, cut):
                out.append((int(anchors[g[0]]), None, None, int(ranges[g[0]]), hashes[g].view(np.int64).tolist(), contents[g].tolist(), (lead[g] - first[piece[g]]).tolist()))
        types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())]
        columns = list(zip(*out, strict=True)) if out else [[] for _ in types]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=["anchor", "content", "edges", "range", "hashes", "contents", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, key, seen = 0, None, set()
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:2] != key:
                    if size >= batch_bytes:
                        yield sort(rows)
                        rows, size = [], 0
                    key, seen = row[:2], set()
                if row[3] not in seen:
                    seen.add(row[3])
                    rows.append(row)
                    size += len(row[4])
        if rows:
            yield sort(rows)

    keyed = pieces.repartition("anchor", "chunk").sortWithinPartitions("anchor", "chunk")
    schema = "anchor long, content long, edges array<int>, range long, hashes array<long>, contents array<long>, places array<int>"
    return keyed.select("anchor", "chunk", "chunks", "content", "bytes").mapInArrow(run, schema)


def _edges(repeated: np.ndarray, length: int) -> list[int]:
    """Byte ranges [begin, end, ...] that repeated windows cover."""
    at = np.flatnonzero(np.diff(np.concatenate([[0], repeated.astype(np.int8), [0]])))
    return _joined([(int(b), int(e) - 1 + length) for b, e in zip(at[::2], at[1::2], strict=True)])


def _joined(ranges: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for b, e in sorted(ranges):
        if out and b <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [b, e]
    return out


def _across_chunks(met: DataFrame, length: int) -> DataFrame:
    """(anchor, content, edges) of windows whose class stands in several chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list) -> Iterator[pa.RecordBatch]:
            hashes, contents, places = (np.concatenate([h[i] for h in held]) for i in (1, 2, 3))
            _, which, uses = np.unique(hashes, return_inverse=True, return_counts=True)
            hit = np.flatnonzero(uses[which] > 1)
            n = len(hit)
            edges = np.stack([places[hit], places[hit] + length], axis=1).reshape(-1).astype(np.int32)
            at = pa.array(np.arange(n + 1) * 2, type=pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([held[0][0][0]] * n, type=pa.int64()), pa.array(contents[hit]), pa.ListArray.from_arrays(at, pa.array(edges))], names=["anchor", "content", "edges"]
            )

        held: list = []
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                key = (row.column(0)[0].as_py(), row.column(1)[0].as_py())
                if held and held[0][0] != key:
                    yield from flush(held)
                    held = []
                held.append((key, *(lists(row.column(j))[0] for j in (2, 3, 4))))
        if held:
            yield from flush(held)

    keyed = met.select("anchor", "range", "hashes", "contents", "places").repartition("anchor", "range").sortWithinPartitions("anchor", "range")
    return keyed.mapInArrow(run, "anchor long, content long, edges array<int>")


def repeats(documents: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, chunk: int = 4000, batch_bytes: int = 1 << 20) -> DataFrame:
    """(t, n, edges): byte ranges to remove of each text that has any, t and n standing for the text."""
    found = _anchors(documents, length, anchor)
    use = found.groupBy("anchor").agg(F.min("content").alias("low"), F.max("content").alias("high"), F.count("*").alias("uses")).where("uses > 1")
    shared = written(found.join(use.select("anchor", (F.col("low") != F.col("high")).alias("mixed")), "anchor"), "stretches")
    # Distinct contents of anchors that have several, each with one place where it stands.
    mixed = shared.where("mixed").groupBy("anchor", "content").agg(F.count("*").alias("uses"), F.min(F.struct("t", "n", "start", "size")).alias("one"))
    mixed = written(mixed, "contents")
    chunks = mixed.groupBy("anchor").agg(F.ceil(F.count("*") / F.lit(chunk)).alias("chunks"))
    places = mixed.join(chunks, "anchor").select("anchor", "content", "chunks", F.pmod("content", F.col("chunks")).alias("chunk"), "one.*")
    by_text = places.groupBy("t", "n").agg(F.collect_list(F.struct("anchor", "chunk", "chunks", "content", "start", "size")).alias("wanted"))
    texts = _texts(documents).where(F.col("n") >= length).select("t", "n", F.col("text").cast("binary").alias("bytes"))
    cut = texts.join(by_text, ["t", "n"]).select("bytes", F.explode("wanted").alias("w"))
    pieces = cut.select("w.anchor", "w.chunk", "w.chunks", "w.content", F.substr("bytes", F.col("w.start") + 1, F.col("w.size")).alias("bytes"))
    judged = written(_sorted_stretches(pieces, length, batch_bytes), "sorted")
    partly = judged.where("edges is not null").select("anchor", "content", "edges")
    partly = partly.unionByName(_across_chunks(judged.where("range is not null"), length))
    partly = partly.groupBy("anchor", "content").agg(F.flatten(F.collect_list("edges")).alias("edges"))
    twice = mixed.where("uses > 1").select("anchor", "content")
    whole = shared.where("not mixed").unionByName(shared.where("mixed").join(twice, ["anchor", "content"], "left_semi").select(*shared.columns))
    whole = whole.select("t", "n", "start", F.array(F.lit(0), F.col("size")).alias("edges"))
    part = shared.where("mixed").join(partly, ["anchor", "content"]).select("t", "n", "start", "edges")
    moved = whole.unionByName(part).select("t", "n", F.transform("edges", lambda e: e + F.col("start")).alias("edges"))
    return moved.groupBy("t", "n").agg(F.flatten(F.collect_set("edges")).alias("edges"))


def removed(documents: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, chunk: int = 4000, batch_bytes: int = 1 << 20) -> DataFrame:
    """(doc_id, kept, n_bytes, spans) for every row: the bytes left, and [begin, end, ...] of those removed."""
    found = repeats(documents, length, anchor, chunk, batch_bytes)
    rows = _texts(documents).join(found, ["t", "n"], "left").select("doc_id", F.col("text").cast("binary").alias("bytes"), "edges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "bytes"):
                kept, spans = [], []
                for raw, edges in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    joined = _joined(list(zip(edges[::2], edges[1::2], strict=True))) if edges else []
                    at = [0, *joined, len(raw)]
                    kept.append(b"".join(raw[a:b] for a, b in zip(at[::2], at[1::2], strict=True)))
                    spans.append(joined)
                sizes = np.diff(buffer(part.column(1))[1])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(kept, type=pa.binary()), pa.array(sizes), pa.array(spans, type=pa.list_(pa.int64()))], names=["doc_id", "kept", "n_bytes", "spans"]
                )

    return rows.mapInArrow(run, "doc_id long, kept binary, n_bytes long, spans array<long>")


def digests(found: DataFrame) -> DataFrame:
    n_removed = F.col("n_bytes") - F.octet_length("kept")
    n_spans = F.expr("size(spans) div 2")
    return found.select("doc_id", "n_bytes", n_removed.cast("long").alias("n_removed"), n_spans.cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


