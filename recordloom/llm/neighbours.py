"""Approximate nearest neighbours by a graph that NN-descent builds and queries search greedily.

Equal vectors become one node, so copies neither fill each other's neighbour lists nor cut the graph in
parts; members are put back at the end. The first graph comes from orders by the bits of random hyperplanes,
cut into blocks whose vectors are compared with each other. Each round of NN-descent joins every node to its
neighbours and to a sample of those it is a neighbour of, compares these with each other, and keeps the nearest
of each. A query starts at a few fixed nodes, and at its own if the index holds it, and expands all nodes
of its beam that are new, until there are none. Graph and search use vectors rounded to 8 bits; scores come
from the originals, in double precision.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do those
of another dimension than the commonest (of equally common ones the larger), nor rows without an id. Of rows
that repeat an id the smallest vector counts. Ties go to the smaller id. With no vectors there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordloom.llm.linear import lists
from recordloom.scratch import written

_BITS = 40


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec) of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull()).where(finite & F.exists("vec", lambda x: x != 0))
    common = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    rows = rows.where(F.size("vec") == (common["d"] if common else 0))
    return rows.groupBy("id").agg(F.min("vec").alias("vec"))


def _rounded(vec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = np.abs(vec).max(axis=1)
    return np.rint(vec / top[:, None] * 127).astype(np.int8), (top / 127).astype(np.float32)


def _nodes(rows: DataFrame) -> DataFrame:
    """(id, vec, code, scale) of the distinct vectors, named by their smallest id."""
    distinct = rows.groupBy("vec").agg(F.min("id").alias("id")).select("id", "vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch) == 0:
                continue
            values, _ = lists(batch.column(1))
            codes, scales = _rounded(values.reshape(len(batch), -1))
            packed = pa.array([c.tobytes() for c in codes], type=pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed, pa.array(scales)], names=["id", "vec", "code", "scale"])

    return distinct.mapInArrow(run, "id long, vec array<double>, code binary, scale float")


def _matrix(codes: pa.Array, scales: pa.Array) -> np.ndarray:
    flat = np.frombuffer(b"".join(codes.to_pylist()), dtype=np.int8)
    return flat.reshape(len(codes), -1).astype(np.float32) * scales.to_numpy(zero_copy_only=False)[:, None]


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of `a` and `b`, over the last two axes."""
    left, right = (a * a).sum(axis=-1), (b * b).sum(axis=-1)
    return np.maximum(left[..., :, None] + right[..., None, :] - 2 * (a @ np.swapaxes(b, -1, -2)), 0)


def _by_block(k: int, block: int):
    """Of each row of a block the k nearest others in it."""

    def compared(ids: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
        d = _squared(m, m)
        np.fill_diagonal(d, np.inf)
        n = min(k, len(ids) - 1)
        near = np.argpartition(d, n - 1, axis=1)[:, :n] if n else np.zeros((len(ids), 0), dtype=np.int64)
        found = [np.repeat(ids, n), ids[near].reshape(-1), np.take_along_axis(d, near, axis=1).reshape(-1).astype(np.float32)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["id", "other", "d"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = np.zeros(0, dtype=np.int64), None
        for batch in batches:
            if len(batch) == 0:
                continue
            m = _matrix(batch.column(1), batch.column(2))
            ids, rows = np.concatenate([ids, batch.column(0).to_numpy()]), m if rows is None else np.concatenate([rows, m])
            while len(ids) >= 2 * block:
                yield compared(ids[:block], rows[:block])
                ids, rows = ids[block:], rows[block:]
        # What is left is up to two blocks long and stays together, or is cut in half.
        for part in np.array_split(np.arange(len(ids)), 2 if len(ids) > 1.5 * block else 1) if len(ids) else []:
            yield compared(ids[part], rows[part])

    return run


def _ordered(nodes: DataFrame, seed: int, block: int, n: int) -> DataFrame:
    """Nodes in the order of hyperplane bits, in partitions of many blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch) == 0:
                continue
            m = _matrix(batch.column(1), batch.column(2))
            planes = np.random.default_rng(seed).standard_normal((m.shape[1], _BITS)).astype(np.float32)
            bits = (m @ planes > 0) @ (np.int64(1) << np.arange(_BITS - 1, -1, -1, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bits)], names=["id", "code", "scale", "bits"])

    coded = nodes.select("id", "code", "scale").mapInArrow(run, "id long, code binary, scale float, bits long")
    parts = max(1, n // (8 * block))
    return coded.repartitionByRange(parts, "bits", "id").sortWithinPartitions("bits", "id").select("id", "code", "scale")


def _nearest(pairs: DataFrame, k: int) -> DataFrame:
    """(id, other, d): the k nearest of each id."""
    once = pairs.groupBy("id", "other").agg(F.min("d").alias("d"))
    rank = F.row_number().over(W.partitionBy("id").orderBy("d", "other"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")


def _adjacent(graph: DataFrame, k: int, seed: int) -> DataFrame:
    """(id, other): neighbours, and a sample of at most k of those that have the id as neighbour."""
    back = graph.select(F.col("other").alias("id"), F.col("id").alias("other"))
    rank = F.row_number().over(W.partitionBy("id").orderBy(F.xxhash64("id", "other", F.lit(seed)), "other"))
    back = back.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")
    return graph.select("id", "other").unionByName(back).distinct()


def _descend(graph: DataFrame, nodes: DataFrame, k: int, seed: int) -> DataFrame:
    """One round: the adjacent nodes of each node are compared with each other and with it."""
    worst = graph.groupBy("id").agg(F.max("d").alias("worst"))
    around = _adjacent(graph, k, seed).unionByName(nodes.select("id", F.col("id").alias("other")))
    known = nodes.select(F.col("id").alias("other"), "code", "scale").join(worst.withColumnRenamed("id", "other"), "other")
    near = around.join(known, "other").groupBy("id").agg(F.collect_list(F.struct("other", "code", "scale", "worst")).alias("near"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 256):
                column = batch.column(0).slice(low, 256)
                first = column.offsets.to_numpy().astype(np.int64)
                flat = column.values.slice(first[0], first[-1] - first[0])
                first = first - first[0]
                ids, worst = flat.field("other").to_numpy(), flat.field("worst").to_numpy()
                m = _matrix(flat.field("code"), flat.field("scale"))
                width = int(np.diff(first).max())
                place = np.minimum(first[:-1, None] + np.arange(width), len(ids) - 1)
                real = np.arange(width) < np.diff(first)[:, None]
                d = _squared(m[place], m[place])
                who = ids[place]
                better = (d < worst[place][:, :, None]) & real[:, :, None] & real[:, None, :] & (who[:, :, None] != who[:, None, :])
                row, a, b = np.nonzero(better)
                found = [who[row, a], who[row, b], d[row, a, b].astype(np.float32)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["id", "other", "d"])

    pairs = near.select("near").mapInArrow(run, "id long, other long, d float")
    return _nearest(graph.unionByName(pairs), k)


def build(nodes: DataFrame, k: int = 20, orders: int = 6, block: int = 2048, rounds: int = 3, seed: int = 42) -> DataFrame:
    """The graph (id, other, d) of `nodes` (id, code, scale)."""
    n = nodes.count()
    found = None
    for i in range(orders):
        near = _ordered(nodes, seed + i, block, n).mapInArrow(_by_block(k, block), "id long, other long, d float")
        found = near if found is None else found.unionByName(near)
    graph = written(_nearest(found, k), "graph")
    for i in range(rounds):
        graph = written(_descend(graph, nodes, k, seed + i), "graph")
    return graph


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distances of a query to the nodes next to one it expands, if they can enter its beam."""
    for batch in batches:
        for low in range(0, len(batch), 256):
            part = batch.slice(low, 256)
            column = part.column(4)
            first = column.offsets.to_numpy().astype(np.int64)
            flat = column.values.slice(first[0], first[-1] - first[0])
            n = np.diff(first)
            if not n.sum():
                continue
            q = _matrix(part.column(1), part.column(2))
            m = _matrix(flat.field("code"), flat.field("scale"))
            row = np.repeat(np.arange(len(part)), n)
            # As products, so that a pair has the same distance wherever it is met.
            d = ((m - q[row]) ** 2).sum(axis=1)
            kept = d < part.column(3).to_numpy()[row]
            found = [part.column(0).to_numpy()[row][kept], flat.field("other").to_numpy()[kept], d[kept].astype(np.float32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["query", "other", "d"])


def search(queries: DataFrame, graph: DataFrame, nodes: DataFrame, k: int = 20, beam: int = 200, entries: int = 8, seed: int = 7) -> DataFrame:
    """(query, other, d): the beam of each query node (id, code, scale) at the end."""
    around = _adjacent(graph, k, seed).join(nodes.select(F.col("id").alias("other"), "code", "scale"), "other")
    beside = around.groupBy("id").agg(F.collect_list(F.struct("other", "code", "scale")).alias("near"))
    # Partitioned by id and kept: each step joins a few rows to it without moving it.
    beside = beside.withColumnRenamed("id", "node").persist(StorageLevel.MEMORY_AND_DISK)
    start = nodes.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(entries).select("id", "code", "scale")
    start = F.broadcast(start.agg(F.collect_list(F.struct(F.col("id").alias("other"), "code", "scale")).alias("near")))
    asked = queries.select(F.col("id").alias("query"), F.col("code").alias("q_code"), F.col("scale").alias("q_scale"))
    far = F.lit(float("inf")).cast("float")
    first = asked.select("query", "q_code", "q_scale", far.alias("worst"), F.lit(0).alias("x")).join(start.withColumn("x", F.lit(0)), "x").drop("x")
    own = asked.select("query", F.col("query").alias("other"), F.lit(0.0).cast("float").alias("d"))
    state = first.mapInArrow(_expand, "query long, other long, d float").unionByName(own)
    state = written(state.groupBy("query", "other").agg(F.min("d").alias("d")).withColumn("done", F.lit(False)), "beam")
    while True:
        fresh = state.where(~F.col("done"))
        if fresh.isEmpty():
            break
        full = state.groupBy("query").agg(F.max("d").alias("top"), F.count("*").alias("n"))
        worst = full.select("query", F.when(F.col("n") >= beam, F.col("top")).otherwise(far).alias("worst"))
        frontier = fresh.select("query", F.col("other").alias("node")).join(worst, "query").join(asked, "query")
        met = frontier.join(beside, "node").select("query", "q_code", "q_scale", "worst", "near").mapInArrow(_expand, "query long, other long, d float")
        both = state.select("query", "other", "d", F.lit(True).alias("done")).unionByName(met.withColumn("done", F.lit(False)))
        once = both.groupBy("query", "other").agg(F.min("d").alias("d"), F.max("done").alias("done"))
        rank = F.row_number().over(W.partitionBy("query").orderBy("d", "other"))
        state = written(once.withColumn("rank", rank).where(F.col("rank") <= beam).drop("rank"), "beam")
    beside.unpersist()
    return state.drop("done")


def nearest(vectors: DataFrame, every: int, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", beam: int = 200, rounds: int = 3) -> DataFrame:
    """(query_id, rank, vec_id, score): of each vector whose id `every` divides, the k nearest others found."""
    rows = written(clean(vectors, id_col, vector_col), "vectors")
    nodes = written(_nodes(rows), "nodes")
    named = rows.join(nodes.select("vec", F.col("id").alias("node")), "vec").select("id", "node")
    # Of a vector's copies only the k + 1 smallest ids can be among the k nearest of anything.
    rank = F.row_number().over(W.partitionBy("node").orderBy("id"))
    members = written(named.withColumn("rank", rank).where(F.col("rank") <= k + 1).drop("rank"), "members")
    asked = written(named.where(F.col("id") % every == 0), "queries")
    codes = nodes.select("id", "code", "scale")
    graph = build(codes, rounds=rounds)
    query_nodes = codes.join(asked.select(F.col("node").alias("id")).distinct(), "id", "left_semi")
    found = search(query_nodes, graph, codes, beam=beam)
    exact = found.select("query", F.col("other").alias("id")).join(nodes.select("id", "vec"), "id")
    exact = exact.join(nodes.select(F.col("id").alias("query"), F.col("vec").alias("q")), "query")
    squares = F.zip_with("vec", "q", lambda a, b: (a - b) * (a - b))
    score = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda a, x: a + x))
    scored = exact.select("query", F.col("id").alias("node"), score.alias("score"))
    best = F.row_number().over(W.partitionBy("query").orderBy("score", "node"))
    scored = scored.withColumn("rank", best).where(F.col("rank") <= k + 1).drop("rank")
    listed = scored.join(members, "node").select("query", F.col("id").alias("vec_id"), "score")
    order = W.partitionBy("query").orderBy("score", "vec_id")
    listed = written(listed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1), "found")
    pairs = asked.select(F.col("id").alias("query_id"), F.col("node").alias("query")).join(listed, "query").where("vec_id != query_id")
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    out = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")
