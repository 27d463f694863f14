"""Language identification of mixed texts: scripts, per-word scores, Viterbi.

A word is a run of letters, by Unicode category, and of marks after them, which do not count as letters. Its script range narrows the languages it may belong to: those that were seen
with that script. Among them a word scores the log probability of its byte n-grams under a model per language,
with hashed counts. A Viterbi pass over the words of a text, with a penalty for each switch, labels spans.
The language of a text is the one whose spans hold most letters; the score is its share of the letters.

Counts come from at most `max_rows` documents with a language that are not held out. Null and empty texts and
texts without a letter are `und` with score 0. Rows whose language is null teach nothing. Ties go to the
language first in order. Without anything learned every text is `und`. Repeated rows are labelled one by one.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm import linear
from recordloom.llm.words import LOWER, Words, buffer, mix, runs, slices

UNKNOWN = "und"
BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)

#: Script ranges (fixed values of the Unicode blocks), as first code points. A range ends where the next begins.
SCRIPTS = [
    (0x0041, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0900, "indic"),
    (0x0E00, "thai"),
    (0x0E80, "other"),
    (0x1100, "hangul"),
    (0x1200, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "sign"),
    (0x2C00, "other"),
    (0x2C60, "latin"),
    (0x2C80, "other"),
    (0x3040, "kana"),
    (0x3100, "other"),
    (0x3400, "han"),
    (0xA000, "other"),
    (0xAC00, "hangul"),
    (0xD800, "other"),
]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_STARTS = np.array([first for first, _ in SCRIPTS])
_NUMBERS = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])

#: Of each code point 1 if it is a letter, 2 if it is a mark, by its Unicode category.
_CATEGORY = np.frombuffer(bytes({"L": 1, "M": 2}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)), dtype=np.uint8)


def _classes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each byte 1 if it is of a letter or of a mark that follows one; and whether a letter begins there."""
    classes = np.where(data < 0x80, _CATEGORY[data], 0).astype(np.uint8)
    lead = np.flatnonzero(data >= 0xC0)
    first = data[lead].astype(np.int64)
    width = 2 + (first >= 0xE0) + (first >= 0xF0)
    point = first & (0x7F >> width)
    longer = [np.flatnonzero(width > k) for k in (1, 2, 3)]
    for k, here in enumerate(longer, 1):
        point[here] = (point[here] << 6) | (data[lead[here] + k] & 0x3F)
    kind = _CATEGORY[point]
    classes[lead] = kind
    for k, here in enumerate(longer, 1):
        classes[lead[here] + k] = kind[here]
    letter = (classes == 1) & ((data & 0xC0) != 0x80)
    mark = np.flatnonzero(classes == 2)
    if len(mark):
        last = np.maximum.accumulate(np.where(classes != 2, np.arange(len(data)), -1))[mark]
        begin = offsets[np.searchsorted(offsets, mark, "right") - 1]
        classes[mark] = (last >= begin) & (classes[np.maximum(last, 0)] == 1)
    return classes, letter


def letter_words(texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """Runs of letters and their marks; the script of each run's first letter; the number of letters of each."""
    data, offsets = buffer(texts)
    classes, letter = _classes(data, offsets)
    data = LOWER[data]
    if len(data) > 1:
        second = data[1:]
        # Capital letters of Latin-1.
        at = np.flatnonzero((data[:-1] == 0xC3) & (second >= 0x80) & (second < 0x9F) & (second != 0x97)) + 1
        data[at] += 0x20
    w = runs(data, offsets, classes)
    n = w.ends - w.starts
    lead = data[w.starts].astype(np.int64)
    point = lead.copy()
    for low, bits, mask in ((0xC0, 1, 0x1F), (0xE0, 2, 0x0F), (0xF0, 3, 0x07)):
        here = np.flatnonzero((lead >= low) & (n > bits))
        value = lead[here] & mask
        for k in range(bits):
            value = (value << 6) | (data[w.starts[here] + k + 1] & 0x3F)
        point[here] = value
    script = _NUMBERS[np.maximum(np.searchsorted(_STARTS, point, "right") - 1, 0)]
    inside = np.concatenate([[0], np.cumsum(letter)])
    return w, script, inside[w.ends] - inside[w.starts]


def ngrams(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte n-grams of all words, each word closed by a mark at both ends, and where those of
    each word begin (one more at the end)."""
    n = w.ends - w.starts + 2
    first = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(first[-1]) - np.repeat(first[:-1] - w.starts + 1, n)
    text = np.where(np.arange(first[-1]) == np.repeat(first[:-1], n), 1, w.data[np.clip(at, 0, max(len(w.data) - 1, 0))]).astype(np.uint64) if len(n) else np.zeros(0, dtype=np.uint64)
    text[first[1:] - 1] = 2
    left = np.repeat(first[1:], n) - np.arange(first[-1])
    out = np.empty((first[-1], len(ORDERS)), dtype=np.int32)
    h = np.zeros(len(text), dtype=np.uint64)
    for k in range(max(ORDERS)):
        ahead = np.zeros(len(text), dtype=np.uint64)
        ahead[: len(text) - k] = text[k:]
        h = h * np.uint64(257) + ahead + np.uint64(1)
        bucket = (mix(h, k) & np.uint64(BUCKETS - 1)).astype(np.int32)
        out[:, k] = np.where(left > k, bucket, -1)
    return out.reshape(-1), first * len(ORDERS)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # log probabilities, a row per bucket; the last row, all 0, stands for no n-gram
    allowed: np.ndarray  # script by language


def train(documents: DataFrame, max_rows: int = 20_000) -> Model:
    known = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    known = known.where(F.col("lang").isNotNull() & ~linear.held_out("doc_id")).groupBy("doc_id").agg(F.min("lang").alias("lang"))
    chosen = linear.sample_ids(known, max_rows)
    rows = linear.sampled(documents.select("doc_id", "text"), chosen).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                names = np.array(part.column(0).to_pylist(), dtype=object)
                for name in sorted(set(names.tolist())):
                    w, script, _ = letter_words(part.column(1).take(pa.array(np.flatnonzero(names == name))))
                    held = counts.setdefault(name, np.zeros(BUCKETS + len(SCRIPT_NAMES)))
                    grams, _ = ngrams(w)
                    held[:BUCKETS] += np.bincount(grams[grams >= 0], minlength=BUCKETS)
                    held[BUCKETS:] += np.bincount(script, minlength=len(SCRIPT_NAMES))
        for name, held in counts.items():
            key = np.flatnonzero(held)
            yield pa.RecordBatch.from_pydict({"lang": [name] * len(key), "key": key.astype(np.int32), "n": held[key].astype(np.int64)}, schema=pa.schema([("lang", pa.string()), ("key", pa.int32()), ("n", pa.int64())]))

    # At most languages x (buckets + scripts) rows.
    total = rows.mapInArrow(run, "lang string, key int, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(total["lang"].to_pylist()))
    counts = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(languages)))
    number = {name: i for i, name in enumerate(languages)}
    if languages:
        counts[total["key"].to_numpy(), [number[x] for x in total["lang"].to_pylist()]] = total["n"].to_numpy()
    grams, scripts = counts[:BUCKETS], counts[BUCKETS:]
    table = np.zeros((BUCKETS + 1, len(languages)), dtype=np.float32)
    table[:-1] = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * BUCKETS)) if languages else 0.0
    # A script belongs to a language in which it makes up a thousandth of the words.
    allowed = scripts >= np.maximum(scripts.sum(axis=0) / 1000, 1)
    allowed[~allowed.any(axis=1)] = True
    return Model(languages, table, allowed)


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word: `scores` has a row per word, `first` where those of each text begin. Texts are
    worked through side by side, the longest first, so that those still going on stand in front."""
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    starts, counts = first[:-1][order], counts[order]
    going = len(counts) - np.searchsorted(counts[::-1], np.arange(counts[0] if len(counts) else 0), "right")
    back = np.zeros(len(scores), dtype=np.int64)
    best = np.zeros((len(starts), scores.shape[1]))
    stay = np.arange(scores.shape[1])
    came = np.zeros(scores.shape, dtype=np.int8 if scores.shape[1] < 128 else np.int32)
    for t, k in enumerate(going):
        now = starts[:k] + t
        top = best[:k].argmax(axis=1)
        switch = best[np.arange(k), top] - penalty
        moved = switch[:, None] > best[:k]
        came[now] = np.where(moved, top[:, None], stay)
        best[:k] = np.where(moved, switch[:, None], best[:k]) + scores[now]
        if t % 64 == 0:
            best[:k] -= best[:k].max(axis=1, keepdims=True)
    label = best.argmax(axis=1)
    for t in range(len(going) - 1, -1, -1):
        k = going[t]
        now = starts[:k] + t
        back[now] = label[:k]
        label[:k] = came[now, label[:k]]
    return back


def label_words(texts: pa.Array, model: Model, penalty: float) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, their letters, and the number of the language of each."""
    w, script, letters = letter_words(texts)
    # Each distinct word once, and in blocks, since the n-grams take many times the room of the words.
    _, one, which = np.unique(w.hashes, return_index=True, return_inverse=True)
    scores = np.zeros((len(one), len(model.languages)), dtype=np.float32)
    for a in range(0, len(one), 1 << 15):
        some = one[a : a + (1 << 15)]
        grams, at = ngrams(Words(w.data, w.starts[some], w.ends[some], w.hashes[some], w.first))
        for j in range(scores.shape[1]):
            scores[a : a + len(some), j] = np.add.reduceat(model.table[grams, j], at[:-1])
    scores = np.where(model.allowed[script[one]], scores, -1e4)
    return w, letters, viterbi(scores[which], w.first, penalty)


def identify(documents: DataFrame, model: Model, penalty: float = 12.0) -> DataFrame:
    """(doc_id, lang_pred, score, spans): spans as structs of language and byte range, first to last word."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    span = pa.struct([("lang", pa.string()), ("begin", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in batches:
            for part in slices(batch, "text"):
                n, base = len(part), buffer(part.column(1))[1]
                if not model.languages:
                    pred, share, at, spans = [UNKNOWN] * n, np.zeros(n), np.zeros(n + 1), pa.array([], type=span)
                else:
                    w, letters, label = label_words(part.column(1), model, penalty)
                    owner = w.text_of()
                    held = np.bincount(owner * len(model.languages) + label, weights=letters, minlength=n * len(model.languages)).reshape(n, -1)
                    total = held.sum(axis=1)
                    pred = names[np.where(total > 0, held.argmax(axis=1), len(model.languages))].tolist()
                    share = held.max(axis=1) / np.maximum(total, 1)
                    opens = np.ones(len(label), dtype=bool)
                    opens[1:] = (label[1:] != label[:-1]) | (owner[1:] != owner[:-1])
                    first = np.flatnonzero(opens)
                    last = np.append(first[1:], len(label))[: len(first)] - 1
                    shift = base[owner[first]]
                    at = np.concatenate([[0], np.cumsum(np.bincount(owner[first], minlength=n))])
                    parts = [pa.array(names[label[first]].tolist(), type=pa.string()), pa.array(w.starts[first] - shift), pa.array(w.ends[last] - shift)]
                    spans = pa.StructArray.from_arrays(parts, fields=list(span))
                found = pa.ListArray.from_arrays(pa.array(at, type=pa.int32()), spans)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(pred, type=pa.string()), pa.array(share), found], names=["doc_id", "lang_pred", "score", "spans"])

    schema = "doc_id long, lang_pred string, score double, spans array<struct<lang: string, begin: long, end: long>>"
    return rows.mapInArrow(run, schema)
