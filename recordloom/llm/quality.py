"""Quality by positive-unlabelled learning: trusted positives, unlabelled web text and a class prior.

The classifier is a logistic model over the form of a text: the shapes of its words, how often words, word
pairs and lines repeat, how long words and lines are, and which signs it uses. It minimises the non-negative
risk of Kiryo et al. (2017), prior * R+(positive) + max(0, R-(unlabelled) - prior * R-(positive)): where the
last part falls below 0, the step goes against it. The prior is estimated as in Garg et al. (2021): a model
that tells positives from unlabelled text ranks fresh rows of both, and the smallest ratio of the shares above
a threshold bounds the share of positives.

Positives are documents labelled 1; documents labelled 0 are not used as such. At most `max_rows` positives
and as many unlabelled documents are taken, none of them held out; every document is scored. Null and empty
texts have the shape of an empty text. Where labels repeat an id, the smaller label holds; null labels are
left out. With no positive the score is the logistic value 0.5 of a model without weights. Repeated documents
are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm import linear
from recordloom.llm.words import NOT_SPACE, UNCHANGED, buffer, frugal, mix, prefix_hash, runs, slices, span_hash, split
from recordloom.scratch import written

BUCKETS = 1 << 13
_GROUPS = 1 << 12  # the first buckets are hashed word shapes, the others binned measures
_BINS = 16
#: Bytes of text that a task reads features of at once: some arrays have 8 bytes for each, and a worker keeps their memory.
_SLICE = 1 << 19

_SHAPE = UNCHANGED.copy()
_SHAPE[0x41:0x5B] = 0x41
_SHAPE[0x61:0x7B] = 0x61
_SHAPE[0x80:] = 0x61
_SHAPE[0x30:0x3A] = 0x30


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words with letters as A and a, digits as 0, and repeats of a letter drawn together."""
    shape = _SHAPE[data]
    kept = np.ones(len(shape), dtype=bool)
    kept[1:] = shape[1:] != shape[:-1]
    kept[starts] = True
    place = np.concatenate([[0], np.cumsum(kept)])
    return mix(span_hash(prefix_hash(shape[kept]), place[starts], place[ends]))


def _repeated(keys: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Share of the keys of each text that the text holds once more."""
    packed = np.sort((owner.astype(np.uint64) << np.uint64(40)) | (keys >> np.uint64(24)))
    again = (packed[1:][packed[1:] == packed[:-1]] >> np.uint64(40)).astype(np.int64)
    return np.bincount(again, minlength=texts) / np.maximum(np.bincount(owner, minlength=texts), 1)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, their values, and where those of each text begin (one more at the end)."""
    data, offsets = buffer(texts)
    n = len(texts)
    w = split(data, offsets, NOT_SPACE, UNCHANGED)
    owner = w.text_of()
    counts = np.diff(w.first)
    each = np.maximum(counts, 1)
    shape = (_shapes(data, w.starts, w.ends) & np.uint64(_GROUPS - 1)).astype(np.int64)
    keys, uses = np.unique(owner * _GROUPS + shape, return_counts=True)
    shape_owner, shape_id = keys // _GROUPS, keys % _GROUPS
    lines = runs(data, offsets, (data != 0x0A).astype(np.uint8))
    line_owner = lines.text_of()
    pair = mix(w.hashes[:-1] * np.uint64(3) + w.hashes[1:], 2) if len(w.hashes) else w.hashes
    inside = owner[:-1] == owner[1:]
    sizes = np.diff(offsets)
    per_byte = lambda which: np.diff(np.concatenate([[0], np.cumsum(which)])[offsets]) / np.maximum(sizes, 1)
    letters = (_SHAPE[data] == 0x61) | (_SHAPE[data] == 0x41)
    measures = [
        (_repeated(w.hashes, owner, n), 1.0),
        (_repeated(pair[inside] if len(pair) else pair, owner[:-1][inside], n), 1.0),
        (np.bincount(owner[1:][w.hashes[1:] == w.hashes[:-1]], minlength=n) / each, 1.0),
        (_repeated(lines.hashes, line_owner, n), 1.0),
        (per_byte(letters), 1.0),
        (per_byte(_SHAPE[data] == 0x41), 1.0),
        (per_byte(_SHAPE[data] == 0x30), 1.0),
        (sizes / each, 16.0),
        (np.log2(1 + counts), 16.0),
        (np.log2(1 + counts / np.maximum(np.bincount(line_owner, minlength=n), 1)), 16.0),
    ]
    bins = np.stack([np.minimum(np.sqrt(np.clip(m / top, 0, 1)) * _BINS, _BINS - 1).astype(np.int64) for m, top in measures], axis=1)
    binned = _GROUPS + bins + np.arange(len(measures)) * _BINS
    feature = np.concatenate([shape_id, binned.reshape(-1)])
    value = np.concatenate([np.sqrt(uses / each[shape_owner]), np.ones(binned.size)])
    row = np.concatenate([shape_owner, np.repeat(np.arange(n), len(measures))])
    order = np.argsort(row, kind="stable")
    return feature[order].astype(np.int32), value[order].astype(np.float32), np.searchsorted(row[order], np.arange(n + 1))


def logits(feature: np.ndarray, value: np.ndarray, first: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return linear.row_sums(weights[feature] * value, first) + weights[-1]


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    feature, first = linear.lists(batch.column(1))
    value, _ = linear.lists(batch.column(2))
    return batch.column(0).to_numpy(zero_copy_only=False) > 0, feature, value, first


def _gradient(batch: pa.RecordBatch, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts and logistic losses, and three gradients: of positives as positive, of positives as negative and
    of unlabelled rows as negative."""
    positive, feature, value, first = _read(batch)
    z = logits(feature, value, first, weights)
    p = linear.sigmoid(z)
    as_negative, sums, grads = np.logaddexp(0, z), [], []
    for g, rows in ((p - 1, positive), (p, positive), (p, ~positive)):
        of_row = np.where(rows, g, 0.0)
        grad = linear.scatter(feature, np.repeat(of_row, np.diff(first)) * value, BUCKETS + 1)
        grad[-1] = of_row.sum()
        grads.append(grad)
    sums = [positive.sum(), (~positive).sum(), as_negative[positive].sum(), as_negative[~positive].sum()]
    return np.array(sums, dtype=np.float64), np.stack(grads)


def _non_negative(prior: float):
    def combine(sums: np.ndarray, grads: np.ndarray) -> np.ndarray:
        p, u = max(sums[0], 1.0), max(sums[1], 1.0)
        negative = grads[2] / u - prior * grads[1] / p
        if sums[3] / u - prior * sums[2] / p < 0:
            return -negative
        return prior * grads[0] / p + negative

    return combine


def _plain(sums: np.ndarray, grads: np.ndarray) -> np.ndarray:
    """Positives against unlabelled rows, both with half the weight."""
    return grads[0] / max(sums[0], 1.0) / 2 + grads[2] / max(sums[1], 1.0) / 2


def _ranks(batch: pa.RecordBatch, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Histograms of the scores of positives and of unlabelled rows."""
    positive, feature, value, first = _read(batch)
    place = np.minimum((linear.sigmoid(logits(feature, value, first, weights)) * BUCKETS).astype(np.int64), BUCKETS - 1)
    held = [linear.scatter(place[rows], None, BUCKETS + 1) for rows in (positive, ~positive)]
    return np.zeros(1), np.stack(held)


def estimate_prior(histograms: np.ndarray, delta: float = 0.1) -> float:
    """Upper bound of the share of positives among the unlabelled, from score histograms of both."""
    above = np.cumsum(histograms[:, ::-1], axis=1)
    n = np.maximum(above[:, -1], 1.0)
    share = above / n[:, None]
    slack = np.sqrt(np.log(4 / delta) / (2 * n))
    bound = (share[1] + slack.sum()) / np.maximum(share[0], 1e-9)
    best = int(np.argmin(np.where(share[0] > 0, bound, np.inf)))
    return float(np.clip(share[1, best] / max(share[0, best], 1e-9), 0.01, 0.99))


def train(documents: DataFrame, labels: DataFrame, max_rows: int = 10_000, rounds: int = 30, rate: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights, the bias last, and the estimated prior."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna()
    known = known.where(~linear.held_out("doc_id")).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    positive = known.where("quality = 1").select("doc_id")
    ids = documents.select(F.col("doc_id").cast("long").alias("doc_id")).where(~linear.held_out("doc_id"))
    # Another order than that of the positives, so that the two samples are independent.
    unlabelled = ids.orderBy(F.xxhash64(F.lit("unlabelled"), "doc_id"), "doc_id").limit(max_rows).distinct()
    groups = linear.sample_ids(positive, max_rows).withColumn("positive", F.lit(1)).unionByName(unlabelled.withColumn("positive", F.lit(0)))
    chosen = linear.sampled(documents, groups).select("positive", F.xxhash64("doc_id", "positive").alias("fold"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                feature, value, first = features(part.column(2))
                at = pa.array(first, type=pa.int32())
                found = [part.column(0), pa.ListArray.from_arrays(at, pa.array(feature)), pa.ListArray.from_arrays(at, pa.array(value)), part.column(1)]
                yield pa.RecordBatch.from_arrays(found, names=["positive", "features", "values", "fold"])

    schema = "positive int, features array<int>, values array<float>, fold long"
    rows = written(chosen.mapInArrow(frugal(run), schema).coalesce(8), "quality")
    half = F.pmod("fold", F.lit(2)) == 0
    trial = linear.fit(rows.where(half), _gradient, _plain, linear.Steps(BUCKETS, rate, 1e-5), rounds)
    found = linear.totals(rows.where(~half), _ranks, trial)
    prior = estimate_prior(found[1]) if found and found[1].sum(axis=1).min() > 0 else 0.5
    return linear.fit(rows, _gradient, _non_negative(prior), linear.Steps(BUCKETS, rate, 1e-5), rounds), prior


def score(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, score)."""
    sent = documents.sparkSession.sparkContext.broadcast(weights)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                z = logits(*features(part.column(1)), sent.value)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(linear.sigmoid(z))], names=["doc_id", "score"])

    return rows.mapInArrow(frugal(run), "doc_id long, score double")


def keep(documents: DataFrame, weights: np.ndarray, threshold: float = 0.3) -> DataFrame:
    """The documents, all their columns, that score at least `threshold`."""
    sent, at = documents.sparkSession.sparkContext.broadcast(weights), documents.columns.index("text")
    return documents.mapInArrow(frugal(lambda batches: _kept(batches, at, sent.value, threshold)), documents.schema)


def _kept(batches: Iterator[pa.RecordBatch], at: int, weights: np.ndarray, threshold: float) -> Iterator[pa.RecordBatch]:
    """The rows whose texts, in column `at`, score at least `threshold`."""
    for batch in batches:
        for part in slices(batch, "text", _SLICE):
            z = logits(*features(part.column(at)), weights)
            yield part.filter(pa.array(linear.sigmoid(z) >= threshold))
