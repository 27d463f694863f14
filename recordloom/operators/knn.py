"""Nearest neighbours over embeddings, as further candidate pairs: `exact_knn` compares all vectors, `knn_pairs` finds
most neighbours with less work.

**Exact.** The vectors are dealt into parts, and any two parts are compared in one cell of a grid, by products of
tiles in single precision. What may be among the k nearest is computed again in double precision. The work grows with the
square of the vectors; a cell has a bounded size, and a vector is sent to as many cells as there are parts.

**By trees.** Several trees are grown over the directions of the distinct vectors. A node with more than `leaf` vectors is split by
three planes at once, each moved to the mean of the node, so that a tight cluster is parted like everything else
(random projection trees, Dasgupta and Freund 2008); all trees grow one level per round. Vectors that share a
leaf of some tree are compared. Then, a few times, the neighbours of every vector are compared with each other and
with it, since near vectors have neighbours in common (Dong, Moses and Li 2011). The rule is one at every size: projections and means are whole numbers, so the trees
do not depend on partitions or on the order of sums. Recall is measured, not promised; more trees and
refinements raise it.

Copies of a vector are one point of the trees. Each of them gets the smallest other ids of its copies first. Points that
`rounds` rounds of planes leave together in more than `chunk` are compared by chunks of consecutive ids. Vectors that
are null, empty, zero or not finite take no part. Work and memory of a task are bounded by the leaf or chunk.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.scratch import written

#: Units of a projection.
SCALE = 1 << 20
#: Planes by which a node is split at once.
SPLIT = 3


def planes(dimension: int, trees: int, rounds: int, seed: int) -> np.ndarray:
    """Plane normals of +1 and -1, by tree and round."""
    return np.random.default_rng(seed).integers(0, 2, (trees, rounds * SPLIT, dimension)) * 2 - 1


def _unit(vectors: list) -> np.ndarray:
    m = np.asarray(vectors, dtype=np.float64)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _projections(normals: np.ndarray):
    flat = normals.reshape(-1, normals.shape[-1]).T.astype(np.float64)

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def project(vectors: pd.Series) -> pd.Series:
        if len(vectors) == 0:
            return pd.Series([], dtype=object)
        # Products of whole numbers below 2^53 are exact in doubles.
        whole = np.rint(_unit(list(vectors)) * SCALE) @ flat
        return pd.Series(list(whole.astype(np.int64)))

    return project


def _grown(points: DataFrame, trees: int, rounds: int, leaf: int) -> DataFrame:
    """(rep, tree, node): the leaf of every point in every tree, from points (rep, projections)."""
    width = rounds * SPLIT
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    rows = points.select("rep", tree, "projections")
    rows = rows.select("rep", "tree", F.lit(0).cast("long").alias("node"), F.slice("projections", F.col("tree") * width + 1, width).alias("at"))
    leaves = None
    for r in range(rounds):
        rows = written(rows, "tree-level")
        here = [F.get("at", F.lit(r * SPLIT + i)) for i in range(SPLIT)]
        sums = [F.sum(p).alias(f"sum{i}") for i, p in enumerate(here)]
        # One row per node of this level.
        nodes = written(rows.groupBy("tree", "node").agg(F.count("*").alias("n"), *sums), "tree-nodes")
        if nodes.where(F.col("n") > leaf).isEmpty():
            break
        placed = rows.join(nodes, ["tree", "node"])
        whole = placed.where(F.col("n") <= leaf).select("rep", "tree", "node")
        leaves = whole if leaves is None else leaves.unionByName(whole)
        side = F.lit(1)
        for i, p in enumerate(here):
            side = side + F.when(F.col("n") * p > F.col(f"sum{i}"), 1 << i).otherwise(0)
        # The digits of a node are its sides on the way down.
        child = F.col("node") * ((1 << SPLIT) + 1) + side
        rows = placed.where(F.col("n") > leaf).select("rep", "tree", child.alias("node"), "at")
    rest = rows.select("rep", "tree", "node")
    return rest if leaves is None else leaves.unionByName(rest)


def _best_of_leaf(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, m = pdf["rep"].to_numpy(), _unit(list(pdf["vector"]))
        sims = np.round(m @ m.T, 6)
        np.fill_diagonal(sims, -np.inf)
        order = np.lexsort((np.broadcast_to(ids, sims.shape), -sims), axis=1)[:, : min(k, len(ids) - 1)]
        rows = np.repeat(np.arange(len(ids)), order.shape[1])
        picked = order.reshape(-1)
        return pd.DataFrame({"rep": ids[rows], "other": ids[picked], "cosine": sims[rows, picked]})

    return run


def _nearest(pairs: DataFrame, k: int) -> DataFrame:
    """The k best (rep, other, cosine) of each point, from pairs found once or more."""
    best = F.row_number().over(W.partitionBy("rep").orderBy(F.desc("cosine"), "other"))
    once = pairs.groupBy("rep", "other").agg(F.max("cosine").alias("cosine"))
    return once.withColumn("place", best).where(F.col("place") <= k).drop("place")


def _points(embeddings: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame]:
    """(id, vector) of the rows that take part, and the distinct vectors with the smallest id of each."""
    rows = embeddings.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    return rows, written(rows.groupBy("vector").agg(F.min("id").alias("rep")), "points")


def _found(rows: DataFrame) -> T.StructType:
    kind = rows.schema["id"].dataType
    return T.StructType([T.StructField("rep", kind), T.StructField("other", kind), T.StructField("cosine", T.DoubleType())])


def _listed(rows: DataFrame, points: DataFrame, near: DataFrame, k: int) -> DataFrame:
    """The k nearest of every row, from (rep, other, cosine) of points."""
    # Of the copies of a point only the first k + 1 ids can be among the k nearest of anything.
    members = written(rows.join(points, "vector").select("rep", "id"), "members")
    first = members.withColumn("place", F.row_number().over(W.partitionBy("rep").orderBy("id"))).where(F.col("place") <= k + 1)
    others = near.join(first.select(F.col("rep").alias("other"), F.col("id").alias("neighbour")), "other").select("rep", "neighbour", "cosine")
    own = first.select("rep", F.col("id").alias("neighbour"), F.lit(1.0).alias("cosine"))
    order = [F.desc("cosine"), "neighbour"]
    best = F.row_number().over(W.partitionBy("rep").orderBy(*order))
    listed = others.unionByName(own).withColumn("place", best).where(F.col("place") <= k + 1).drop("place")
    # Each id takes k of its point's k + 1, itself left out.
    found = members.join(listed, "rep").where(F.col("id") != F.col("neighbour"))
    rank = F.row_number().over(W.partitionBy("id").orderBy(*order))
    return found.select("id", "neighbour", "cosine", rank.alias("rank")).where(F.col("rank") <= k)


#: Vectors compared at once, and neighbours of which the nearest is looked at first.
_TILE, _GROUP = 256, 64
#: Numbers in the vectors of a part.
_NUMBERS = 1 << 21


def _best_of_tile(ids: np.ndarray, a: np.ndarray, others: np.ndarray, b: np.ndarray, k: int, same: bool) -> pd.DataFrame:
    """The k nearest of `b` for each of `a`, unit vectors in double precision. With `same`, a vector is not its own."""
    k = min(k, len(others) - same)
    coarse, found = b.astype(np.float32).T, []
    # What single precision and the rounding to six places may move.
    margin = np.float32(4e-6 + a.shape[1] * 2.4e-7)
    ends = np.arange(0, len(others), _GROUP)
    for start in range(0, len(ids) if k > 0 else 0, _TILE):
        tile = a[start : start + _TILE]
        sims = tile.astype(np.float32) @ coarse
        if same:
            own = np.nonzero(ids[start : start + _TILE, None] == others)
            sims[own] = -np.inf
        # At least k vectors reach the k-th best of the groups' best.
        best = np.maximum.reduceat(sims, ends, axis=1) if len(ends) >= k else sims
        floor = np.partition(best, best.shape[1] - k, axis=1)[:, best.shape[1] - k]
        reached = sims >= (floor - margin)[:, None]
        if same:
            reached[own] = False
        row, col = np.nonzero(reached)
        cosine = np.concatenate([np.einsum("ij,ij->i", tile[row[i : i + 65536]], b[col[i : i + 65536]]) for i in range(0, len(row), 65536)])
        cosine = np.round(cosine, 6)
        order = np.lexsort((others[col], -cosine, row))
        row, col, cosine = row[order], col[order], cosine[order]
        first = np.searchsorted(row, row) + k > np.arange(len(row))
        found.append(pd.DataFrame({"rep": ids[start + row[first]], "other": others[col[first]], "cosine": cosine[first]}))
    return pd.concat(found) if found else pd.DataFrame({"rep": ids[:0], "other": others[:0], "cosine": np.zeros(0)})


def _best_of_cell(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, m, part = pdf["rep"].to_numpy(), _unit(list(pdf["vector"])), pdf["part"].to_numpy()
        low, high = part == part.min(), part == part.max()
        if low.all():
            # The cell of one part, or of two of which one is empty.
            return _best_of_tile(ids, m, ids, m, k, True) if pdf["i"].iloc[0] == pdf["j"].iloc[0] else pdf[["rep"]].iloc[:0].assign(other=ids[:0], cosine=0.0)
        return pd.concat([_best_of_tile(ids[x], m[x], ids[y], m[y], k, False) for x, y in ((low, high), (high, low))])

    return run


def exact_knn(embeddings: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, neighbour, cosine, rank): the k most similar other vectors of each, of all there are, ties by id."""
    rows, points = _points(embeddings, id_col, vector_col)
    size = points.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("d")).first()
    # Small tables are cut as well, to keep many cores busy.
    parts = max(-(-size["n"] * (size["d"] or 1) // _NUMBERS), min(8, -(-size["n"] // 1024)), 1)
    dealt = points.withColumn("part", F.pmod(F.xxhash64("rep"), F.lit(parts)).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("other")
    sent = dealt.select("rep", "vector", "part", other).select("rep", "vector", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    # Much work on few bytes: three times as many places as cells, so that few cells share one.
    cells = sent.repartition(3 * parts * (parts + 1) // 2, "i", "j").groupBy("i", "j").applyInPandas(_best_of_cell(k), _found(rows))
    # Every two vectors meet once.
    best = F.row_number().over(W.partitionBy("rep").orderBy(F.desc("cosine"), "other"))
    near = cells.withColumn("place", best).where(F.col("place") <= k).drop("place")
    return _listed(rows, points, written(near, "neighbours"), k)


def knn_pairs(
    embeddings: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    trees: int = 12,
    leaf: int = 256,
    rounds: int = 10,
    chunk: int = 1024,
    refinements: int = 3,
    seed: int = 42,
) -> DataFrame:
    """(id, neighbour, cosine, rank): the k most similar other vectors found of each, ties by id."""
    rows, points = _points(embeddings, id_col, vector_col)
    dimension = points.agg(F.max(F.size("vector"))).first()[0] or 1
    project = _projections(planes(dimension, trees, rounds, seed))
    leaves = _grown(points.select("rep", project("vector").alias("projections")), trees, rounds, leaf)
    place = F.row_number().over(W.partitionBy("tree", "node").orderBy("rep"))
    leaves = leaves.withColumn("chunk", F.floor((place - 1) / chunk))
    schema = _found(rows)
    met = leaves.join(points, "rep").groupBy("tree", "node", "chunk").applyInPandas(_best_of_leaf(k), schema)
    # Twice as many as asked for are kept while the graph is refined.
    near = written(_nearest(met, 2 * k), "neighbours")
    for _ in range(refinements):
        circle = near.select(F.col("rep").alias("centre"), F.col("other").alias("rep"))
        circle = circle.unionByName(points.select(F.col("rep").alias("centre"), "rep"))
        # A circle has at most 2k + 1 vectors.
        met = circle.join(points, "rep").groupBy("centre").applyInPandas(_best_of_leaf(k), schema)
        near = written(_nearest(met.unionByName(near), 2 * k), "neighbours")
    return _listed(rows, points, near, k)
