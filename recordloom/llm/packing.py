"""Hierarchical multi-length packing of token sequences.

Every partition packs its own documents, so nothing is shuffled. A document of `longest` tokens or more
first gives whole windows of that size. What is left is routed to the shortest of the tiers that holds
it. Each tier, longest first, opens a window per document and fills the gap from shorter documents, the
largest that fits first; where none fits, a shorter one is cut. Windows that find no filling are joined
to windows of the longest tier, and the rest of a partition is cut at powers of two, so no sequence is
padded. Finally the sequences of a block are dealt to step groups of nearly equal token counts.

A null text counts as empty, and an empty one holds just the end token. Repeated rows and rows without
an id are packed like any others. An empty table gives an empty result. Only `doc_id` and `text` are
read, so further columns do no harm.
"""

from __future__ import annotations

import heapq
import json
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recordloom.llm.words import LOWER, NOT_SPACE, UNCHANGED, Words, buffer, mix, runs, slices, words

TIERS = (512, 1024, 2048, 4096)
END = 2
SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, window int, step_group long"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("window", pa.int32()),
        ("step_group", pa.int64()),
    ]
)


_SPACE, _LETTER, _DIGIT, _SIGN, _HARD = range(5)
_CLASS = np.full(256, _SIGN, dtype=np.uint8)
_CLASS[0x80:] = _HARD
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_CLASS[0x30:0x3A] = _DIGIT
#: Apostrophes, where the tokenizer splits in its own way, control signs, and what special tokens begin with.
_CLASS[[*range(0x00, 0x09), *range(0x0E, 0x20), 0x27, 0x3C, 0x7F]] = _HARD


#: The parts of a tokenizer file under which `pretokens` holds: compose, fold case, drop white space, take runs of
#: letters and of signs apart, then byte-level BPE.
_PLAIN_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_PLAIN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies (fixed by that format)."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def pretokens(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """Runs that the tokenizer encodes apart from each other, case folded, and their classes. What stands
    between white space and holds anything else than ASCII and Latin-1 letters, digits and plain signs is one
    run of class _HARD, as it was."""
    classes, folded = _CLASS[data], LOWER[data]
    lead = np.flatnonzero(data[:-1] == 0xC3) if len(data) else np.zeros(0, dtype=np.int64)
    # The two bytes of a letter of U+00C0 to U+00FF, which are all but the signs for times and division.
    second = data[lead + 1]
    lead, second = lead[letter := (second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)], second[letter]
    classes[lead] = classes[lead + 1] = _LETTER
    folded[lead[second < 0x9F] + 1] += 0x20
    if (classes == _HARD).any():
        chunks = runs(data, offsets, (classes != _SPACE).astype(np.uint8))
        hard = np.concatenate([[0], np.cumsum(classes == _HARD)])
        for i in np.flatnonzero(hard[chunks.ends] > hard[chunks.starts]):
            s, e = chunks.starts[i], chunks.ends[i]
            classes[s:e], folded[s:e] = _HARD, data[s:e]
    w = runs(folded, offsets, classes, _DIGIT)
    kinds = classes[w.starts]
    return Words(w.data, w.starts, w.ends, np.where(kinds == _HARD, mix(w.hashes, 3), w.hashes), w.first), kinds


class ChunkEncoder:
    """Token ids of texts, from those of their runs. The tokenizer must drop white space and never join over
    it, so a run between white space has the same ids wherever it stands. If the tokenizer file has the
    parts stated above, runs are cut further and go to its BPE model directly, which spares them the pattern
    matching of the whole tokenizer. Each distinct run is encoded once while the table of known runs lasts."""

    def __init__(self, path: str, known: int = 1_500_000):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        normalizers = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        patterns = [s["pattern"].get("Regex") for s in splits if s["type"] == "Split"]
        specials = all(t["content"].startswith("<") for t in spec.get("added_tokens", []))
        self.plain = normalizers == _PLAIN_NORMALIZERS and patterns == [_PLAIN_SPLIT] and specials
        self.letters = _byte_letters()
        self.limit = known
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.at = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.pool = np.zeros(0, dtype=np.uint32)

    def learn(self, pieces: list[bytes], hard: list[bool], hashes: np.ndarray) -> None:
        bpe = self.tokenizer.model.tokenize
        encoded = [None if h else [t.id for t in bpe(p.decode("latin-1").translate(self.letters))] for p, h in zip(pieces, hard, strict=True)]
        whole = [i for i, h in enumerate(hard) if h]
        texts = [pieces[i].decode("utf-8", "replace") for i in whole]
        for i, e in zip(whole, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            encoded[i] = e.ids
        count = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        flat = np.fromiter(chain.from_iterable(encoded), dtype=np.uint32, count=int(count.sum()))
        at = np.concatenate([self.at, len(self.pool) + np.cumsum(count) - count])
        self.pool = np.concatenate([self.pool, flat])
        hashes, count = np.concatenate([self.hashes, hashes]), np.concatenate([self.count, count])
        order = np.argsort(hashes)
        self.hashes, self.at, self.count = hashes[order], at[order], count[order]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids and, for each text, where its ids begin (one more at the end)."""
        if self.plain:
            w, kinds = pretokens(*buffer(texts))
        else:
            w = words(texts, NOT_SPACE, UNCHANGED)
            kinds = np.full(len(w.hashes), _HARD)
        distinct, first, which = np.unique(w.hashes, return_index=True, return_inverse=True)
        if len(self.hashes) + len(distinct) > self.limit:
            self.forget()
        place = np.searchsorted(self.hashes, distinct)
        new = np.ones(len(distinct), dtype=bool)
        inside = place < len(self.hashes)
        new[inside] = self.hashes[place[inside]] != distinct[inside]
        if new.any():
            at = first[new]
            spans = zip(w.starts[at].tolist(), w.ends[at].tolist(), strict=True)
            self.learn([w.data[s:e].tobytes() for s, e in spans], (kinds[at] == _HARD).tolist(), distinct[new])
            place = np.searchsorted(self.hashes, distinct)
        count = self.count[place][which] if len(distinct) else np.zeros(0, dtype=np.int64)
        at = self.at[place][which] if len(distinct) else count
        ends = np.cumsum(count)
        source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(at - (ends - count), count)
        return self.pool[source], np.concatenate([[0], ends])[w.first]


@cache
def _encoder(path: str) -> ChunkEncoder:
    """One per Python worker, so that later tasks find the runs that earlier ones met."""
    return ChunkEncoder(path)


class Packer:
    """Packs the documents of one partition, block by block."""

    def __init__(self, partition: int, tiers: tuple[int, ...], step_tokens: int):
        self.tiers, self.longest, self.step_tokens = sorted(tiers), max(tiers), step_tokens
        self.next_sequence = self.next_step = partition << 40
        self.rest: list[tuple] = []  # what a block left, to go on with in the next
        self.waiting: list[tuple] = []
        self.tokens = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.waiting.append((doc_id, 0, ids, len(ids)))
        self.tokens += len(ids)

    def pack(self, last: bool) -> list[list[tuple]]:
        """Sequences of the waiting documents as lists of pieces (doc_id, start, ids, doc_tokens)."""
        done: list[list[tuple]] = []
        shelf: dict[int, list[tuple]] = {}
        sizes: list[int] = []

        def put(piece: tuple) -> None:
            n = len(piece[2])
            if n not in shelf:
                shelf[n] = []
                insort(sizes, n)
            shelf[n].append(piece)

        def take(i: int) -> tuple:
            n = sizes[i]
            piece = shelf[n].pop()
            if not shelf[n]:
                del shelf[n], sizes[i]
            return piece

        for piece in self.waiting:
            while len(piece[2]) >= self.longest:
                head, piece = _cut(piece, self.longest)
                done.append([head])
            if len(piece[2]):
                put(piece)
        self.waiting, self.tokens = [], 0
        open_ended = self.rest
        for tier in reversed(self.tiers):
            while sizes and sizes[-1] > (tier // 2 if tier > self.tiers[0] else 0):
                window = [take(len(sizes) - 1)]
                gap = tier - len(window[0][2])
                while gap and sizes:
                    i = bisect_right(sizes, gap) - 1
                    if i >= 0:
                        piece = take(i)
                    else:
                        piece, tail = _cut(take(0), gap)
                        put(tail)
                    window.append(piece)
                    gap -= len(piece[2])
                if gap:
                    open_ended = open_ended + window
                else:
                    done.append(window)
        window, size = [], 0
        for piece in open_ended:
            while size + len(piece[2]) >= self.longest:
                head, piece = _cut(piece, self.longest - size)
                done.append([*window, head])
                window, size = [], 0
            if len(piece[2]):
                window.append(piece)
                size += len(piece[2])
        self.rest = window
        if last:
            done += _powers(window)
            self.rest = []
        return done

    def rows(self, last: bool) -> Iterator[pa.RecordBatch]:
        sequences = self.pack(last)
        if not sequences:
            return
        totals = [sum(len(p[2]) for p in s) for s in sequences]
        groups = [(0, g) for g in range(max(1, round(sum(totals) / self.step_tokens)))]
        out: list[list] = [[] for _ in _ARROW]
        for i in sorted(range(len(sequences)), key=lambda i: -totals[i]):
            load, group = heapq.heappop(groups)
            heapq.heappush(groups, (load + totals[i], group))
            offset = 0
            for doc_id, start, ids, doc_tokens in sequences[i]:
                row = (doc_id, start, len(ids), ids.astype("<u4").tobytes(), doc_tokens, self.next_sequence, offset, totals[i], self.next_step + group)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
                offset += len(ids)
            self.next_sequence += 1
        self.next_step += len(groups)
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(out, _ARROW, strict=True)], schema=_ARROW)


def _cut(piece: tuple, n: int) -> tuple[tuple, tuple]:
    doc_id, start, ids, total = piece
    return (doc_id, start, ids[:n], total), (doc_id, start + n, ids[n:], total)


def _powers(window: list[tuple]) -> list[list[tuple]]:
    """A window shorter than the longest tier as sequences whose lengths are powers of two."""
    left, out, pieces = sum(len(p[2]) for p in window), [], list(reversed(window))
    while left:
        room = size = 1 << (left.bit_length() - 1)
        sequence = []
        while room:
            piece = pieces.pop()
            if len(piece[2]) > room:
                piece, tail = _cut(piece, room)
                pieces.append(tail)
            sequence.append(piece)
            room -= len(piece[2])
        out.append(sequence)
        left -= size
    return out


def pack(
    documents: DataFrame,
    tokenizer_path: str,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = 16 * max(TIERS),
    block_tokens: int = 1 << 20,
    end: int = END,
) -> DataFrame:
    """One row per piece: where it lies in its document and its sequence, its ids (little-endian, 32 bits
    each), the sequence's length as `window`, and the training step it belongs to. Tiers are powers of two."""
    if any(t <= 0 or t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        packer = Packer(TaskContext.get().partitionId(), tiers, step_tokens)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, first = encoder.encode(part.column(1))
                for i, doc_id in enumerate(part.column(0).to_pylist()):
                    packer.add(doc_id, np.append(ids[first[i] : first[i + 1]], np.uint32(end)))
                    if packer.tokens >= block_tokens:
                        yield from packer.rows(last=False)
        yield from packer.rows(last=True)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    columns = [F.crc32("ids").alias("ids_crc32") if c == "ids" else F.col(c) for c in pieces.columns]
    return pieces.select(*columns)
