"""Toxicity by multiple-instance learning: only documents have labels, sentences are scored.

A sentence is a run of text between line ends and the marks . ! ? and its score is a logistic function of
the words it holds. A document is toxic when at least one sentence is: its probability is the noisy-or,
1 - prod(1 - p), of its sentences. Minimising the log loss of the documents thus trains the sentence scorer,
which then locates the offending sentences. Only words that
stand in toxic documents clearly more or less often than in others, counted first, get a weight.

The model is fitted on at most `max_rows` labelled documents, those with the smallest id hashes; every
document is scored. Null and empty texts have no sentences and the score 0. Where labels repeat an id, the
larger label holds; rows with a null label are left out. Without any labelled row all weights are 0.
Repeated documents are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm import linear
from recordloom.llm.words import Words, buffer, mix, slices, words
from recordloom.scratch import written

BUCKETS = 1 << 18
BIAS = -4.0
#: Lengths of word beginnings in bytes. The last bucket stands for their absence and never gets a weight.
PREFIXES = (4, 5, 6)
WIDTH = 1 + len(PREFIXES)
_END = np.zeros(256, dtype=bool)
_END[[0x0A, 0x0D, 0x21, 0x2E, 0x3F]] = True


def sentences(texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, the first word of each sentence and the first sentence of each text (one more at the end)."""
    w = words(texts)
    ends = np.concatenate([[0], np.cumsum(_END[w.data])])
    number = ends[w.starts]
    opens = np.ones(len(number), dtype=bool)
    opens[1:] = number[1:] != number[:-1]
    opens[w.first[:-1][w.first[:-1] < len(number)]] = True
    first = np.append(np.flatnonzero(opens), len(number))
    return w, first, np.searchsorted(first, w.first)


def _features(w: Words) -> np.ndarray:
    """Buckets of each word: of the word itself, and of its first bytes where it goes on after them, since
    offending words are inflected."""
    out = np.empty((len(w.hashes), 1 + len(PREFIXES)), dtype=np.int32)
    out[:, 0] = (w.hashes & np.uint64(BUCKETS - 1)).astype(np.int32)
    length, h = w.ends - w.starts, np.zeros(len(w.hashes), dtype=np.uint64)
    for k in range(max(PREFIXES)):
        inside = np.minimum(w.starts + k, w.ends - 1)
        h = mix(h * np.uint64(257) + w.data[inside], 5)
        if k + 1 in PREFIXES:
            bucket = (h & np.uint64(BUCKETS - 1)).astype(np.int32)
            out[:, 1 + PREFIXES.index(k + 1)] = np.where(length > k + 1, bucket, BUCKETS - 1)
    return out.reshape(-1)


def probabilities(features: np.ndarray, first: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of each sentence; `first` holds where the features of each begin."""
    return linear.sigmoid(linear.row_sums(weights[features], first) + weights[-1])


def noisy_or(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    return -np.expm1(linear.row_sums(np.log1p(-np.minimum(p, 1 - 1e-12)), first))


def _gradient(batch: pa.RecordBatch, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    label = batch.column(0).to_numpy(zero_copy_only=False).astype(np.float64)
    features, _ = linear.lists(batch.column(1))
    lengths, of_text = linear.lists(batch.column(2))
    first = np.concatenate([[0], np.cumsum(lengths)])
    p = probabilities(features, first, weights)
    whole = np.clip(noisy_or(p, of_text), 1e-9, 1.0)
    # d loss / d z = p for a clean document, p - p / P for a toxic one.
    pull = np.repeat(label / whole, np.diff(of_text))
    g = p - p * pull
    per_word = np.repeat(g, lengths)
    grad = linear.scatter(features, per_word, BUCKETS + 1)
    grad[-1] = g.sum()
    return np.array([float(len(label))]), grad[None, :]


def _counts(batch: pa.RecordBatch, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Clean and toxic documents, and how many of each hold a word of each bucket."""
    label = batch.column(0).to_numpy(zero_copy_only=False) > 0
    features, first = linear.lists(batch.column(1))
    owner = np.repeat(np.arange(len(label)), np.diff(first))
    pairs = np.unique(owner.astype(np.int64) * BUCKETS + features)
    toxic, bucket = label[pairs // BUCKETS], pairs % BUCKETS
    held = [linear.scatter(bucket[toxic == t], None, BUCKETS + 1) for t in (False, True)]
    return np.array([(~label).sum(), label.sum()], dtype=np.float64), np.stack(held)


def _telling(documents: np.ndarray, held: np.ndarray, z: float = 4.0, least: int = 5) -> np.ndarray:
    """Buckets whose words stand in toxic documents more or less often than chance explains."""
    share = held.sum(axis=0) / max(documents.sum(), 1.0)
    expected = share * documents[1]
    spread = np.sqrt(np.maximum(expected * (1 - share) * documents[0] / max(documents.sum(), 1.0), 1e-9))
    chosen = (np.abs(held[1] - expected) >= z * spread) & (held.sum(axis=0) >= least)
    chosen[BUCKETS - 1] = False
    return chosen


def train(documents: DataFrame, labels: DataFrame, max_rows: int = 20_000, rounds: int = 25, rate: float = 2.0) -> np.ndarray:
    """Weights of word buckets, the bias last, from documents that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    known = known.where(~linear.held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = linear.sampled(documents, linear.sample_ids(known, max_rows)).select("toxic", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w, first, of_text = sentences(part.column(1))
                word_lists = pa.ListArray.from_arrays(pa.array(w.first * WIDTH, type=pa.int32()), pa.array(_features(w)))
                lengths = pa.ListArray.from_arrays(pa.array(of_text, type=pa.int32()), pa.array(np.diff(first * WIDTH).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), word_lists, lengths], names=["toxic", "words", "lengths"])

    rows = written(chosen.mapInArrow(run, "toxic int, words array<int>, lengths array<int>").coalesce(8), "toxicity")
    none = np.zeros(BUCKETS + 1)
    none[-1] = BIAS
    if (found := linear.totals(rows, _counts, none)) is None:
        return none.astype(np.float32)
    steps = linear.Steps(BUCKETS, rate, 2e-5, BIAS, _telling(*found)[:-1])
    return linear.fit(rows, _gradient, lambda sums, grads: grads[0] / sums[0], steps, rounds)


def score(documents: DataFrame, weights: np.ndarray, threshold: float = 0.5) -> DataFrame:
    """(doc_id, score, toxic_sentences): the last are the byte ranges [begin, end, begin, end, ...], first to
    last word, of the sentences that score at least `threshold`."""
    sent = documents.sparkSession.sparkContext.broadcast(weights)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w, first, of_text = sentences(part.column(1))
                p = probabilities(_features(w), first * WIDTH, sent.value)
                hit = np.flatnonzero(p >= threshold)
                spans = np.stack([w.starts[first[hit]], w.ends[first[hit + 1] - 1]], axis=1)
                owner = np.searchsorted(of_text, hit, "right") - 1
                base = buffer(part.column(1))[1]
                spans = spans - base[owner][:, None]
                at = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(part)))]) * 2
                found = pa.ListArray.from_arrays(pa.array(at, type=pa.int32()), pa.array(spans.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(noisy_or(p, of_text)), found], names=["doc_id", "score", "toxic_sentences"])

    return rows.mapInArrow(run, "doc_id long, score double, toxic_sentences array<long>")
