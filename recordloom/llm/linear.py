"""Linear models fitted by gradient jobs: each step broadcasts the weights, every task sums the gradient of
its rows, and the driver adds these sums, of fixed size, and moves the weights."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: rows as arrow batch, weights -> (sums, gradients): `sums` is a short vector, `gradients` one row per term.
Gradient = Callable[[pa.RecordBatch, np.ndarray], tuple[np.ndarray, np.ndarray]]


@dataclass
class Steps:
    """Adagrad with soft thresholding: weights whose gradient stays under `l1` stay 0. Where `allowed` is given,
    the others stay 0 too. The last weight is the bias."""

    size: int
    rate: float
    l1: float
    bias: float = 0.0
    allowed: np.ndarray | None = None

    def __post_init__(self):
        self.weights = np.zeros(self.size + 1)
        self.weights[-1] = self.bias
        self.squares = np.full(self.size + 1, 1e-8)

    def move(self, gradient: np.ndarray) -> None:
        self.squares += gradient**2
        step = self.rate / np.sqrt(self.squares)
        w = self.weights - step * gradient
        w[:-1] = np.sign(w[:-1]) * np.maximum(np.abs(w[:-1]) - step[:-1] * self.l1, 0.0)
        if self.allowed is not None:
            w[:-1] *= self.allowed
        self.weights = w


def totals(rows: DataFrame, gradient: Gradient, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Sums and gradients over all rows; None where there are none."""
    sent = rows.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = grads = None
        for batch in batches:
            s, g = gradient(batch, sent.value)
            sums, grads = (s, g) if sums is None else (sums + s, grads + g)
        if sums is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "sums": [sums.astype("<f8").tobytes()], "grads": [grads.astype("<f4").tobytes()]},
                schema=pa.schema([("part", pa.int32()), ("sums", pa.binary()), ("grads", pa.binary())]),
            )

    found = sorted(rows.mapInArrow(run, "part int, sums binary, grads binary").collect(), key=lambda r: r["part"])
    sent.unpersist()
    if not found:
        return None
    sums = sum(np.frombuffer(r["sums"], dtype="<f8") for r in found)
    grads = sum(np.frombuffer(r["grads"], dtype="<f4").astype(np.float64) for r in found)
    return sums, grads.reshape(-1, len(weights))


def fit(rows: DataFrame, gradient: Gradient, combine: Callable[[np.ndarray, np.ndarray], np.ndarray], steps: Steps, rounds: int) -> np.ndarray:
    """`rounds` steps over `rows`; `combine` turns the sums and gradients of all rows into one gradient."""
    for _ in range(rounds):
        if (found := totals(rows, gradient, steps.weights)) is None:
            break
        steps.move(combine(*found))
    return steps.weights.astype(np.float32)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the stretches of `values` that begin at `first` (one more at the end); empty ones are 0."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]


def scatter(features: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(features, weights=values, minlength=size)


def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list array and where each row begins (one more at the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    first = column.offsets.to_numpy().astype(np.int64)
    return column.values.slice(first[0], first[-1] - first[0]).to_numpy(zero_copy_only=False), first - first[0]


def held_out(doc_id: str) -> Column:
    """Rows no label is learned from: a fifth, by the checksum of the id. Rows without an id are among them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def sample_ids(ids: DataFrame, limit: int) -> DataFrame:
    """At most `limit` rows of a table that has a `doc_id`: those whose ids have the smallest hashes."""
    return ids.orderBy(F.xxhash64("doc_id"), *ids.columns).limit(limit)


def sampled(documents: DataFrame, chosen: DataFrame) -> DataFrame:
    """The texts of chosen ids. `chosen` must be of bounded size: it is broadcast."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")
