"""Isolation forest (Liu, Ting and Zhou, 2008) as Spark jobs.

Every tree draws its own subsample with a hash of the row id, so drawing is one narrow pass. A tree is
grown from its subsample in one task (at most a few hundred rows). The forest is bounded by trees and
subsample size, whatever the data; rows are scored in place, in batches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.scratch import written

EULER = 0.5772156649015329
#: Largest error of the flagged share, where scores do not tie.
ERROR = 1e-4


def mean_path(n: float) -> float:
    """Average depth of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


def subsamples(rows: DataFrame, key: str, columns: list[str], trees: int, size: int, total: int, seed: int) -> DataFrame:
    """(tree, rank, columns): for every tree, slightly more than `size` rows in random order."""
    # Six standard deviations above the wanted size leave no tree short.
    share = min(1.0, (size + 6.0 * math.sqrt(size)) / max(total, 1))
    limit = int(share * (2**62 - 1))

    def draw(tree):
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed), tree, F.col(key)), 2)

    drawn = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) <= limit),
        lambda t: F.struct(t.alias("tree"), draw(t).alias("rank")),
    )
    return rows.select(F.explode(drawn).alias("d"), *columns).select("d.tree", "d.rank", *columns)


def grow_tree(points: np.ndarray, rng: np.random.Generator) -> list[tuple[int, int, float, int, float]]:
    """Nodes (node, column, split, right child, depth value); column -1 marks a leaf."""
    deepest = math.ceil(math.log2(max(len(points), 2)))
    nodes: list[list[float]] = []
    todo = [(points, 0, -1)]
    while todo:
        part, depth, parent = todo.pop()
        me = len(nodes)
        if parent >= 0:
            nodes[parent][3] = me
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= deepest or len(part) <= 1 or len(usable) == 0:
            nodes.append([me, -1, 0.0, -1, depth + mean_path(len(part))])
            continue
        column = int(rng.choice(usable))
        split = float(rng.uniform(low[column], high[column]))
        nodes.append([me, column, split, -1, 0.0])
        goes_left = part[:, column] < split
        # The left child follows its parent directly; the right child is linked when it is reached.
        todo.append((part[~goes_left], depth + 1, me))
        todo.append((part[goes_left], depth + 1, -1))
    return [tuple(n) for n in nodes]


def fit_forest(rows: DataFrame, key: str, columns: list[str], trees: int = 100, sample: int = 256, seed: int = 42) -> pd.DataFrame:
    """The nodes of all trees, at most trees * (2 * sample - 1) rows."""
    total = rows.count()

    fields = ["tree", "node", "column", "split", "right", "depth", "size"]

    def grow(tree_key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(tree_key[0])
        pdf = pdf.sort_values(["rank", *columns]).head(sample)
        rng = np.random.default_rng([seed, tree])
        nodes = pd.DataFrame(
            grow_tree(pdf[columns].to_numpy(dtype=float), rng), columns=["node", "column", "split", "right", "depth"]
        )
        return nodes.assign(tree=tree, size=len(pdf))[fields]

    schema = "tree int, node int, column int, split double, right int, depth double, size int"
    drawn = subsamples(rows, key, columns, trees, sample, total, seed)
    grown = drawn.groupBy("tree").applyInPandas(grow, schema)
    return grown.orderBy("tree", "node").toPandas()


def _depths(points: np.ndarray, tree: dict[str, np.ndarray]) -> np.ndarray:
    at = np.zeros(len(points), dtype=np.int64)
    while True:
        column = tree["column"][at]
        inner = np.flatnonzero(column >= 0)
        if len(inner) == 0:
            return tree["depth"][at]
        here = at[inner]
        left = points[inner, column[inner]] < tree["split"][here]
        at[inner] = np.where(left, here + 1, tree["right"][here])


def score_forest(rows: DataFrame, forest: pd.DataFrame, columns: list[str]) -> DataFrame:
    """Add `outlier_score` in (0, 1]; larger is more isolated."""
    fields = ["column", "split", "right", "depth"]
    trees = [{f: part[f].to_numpy() for f in fields} for _, part in forest.groupby("tree", sort=True)]
    scale = mean_path(float(forest.groupby("tree")["size"].first().mean())) or 1.0
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            points, back = np.unique(pdf[columns].to_numpy(dtype=float), axis=0, return_inverse=True)
            depth = np.mean([_depths(points, t) for t in shared.value], axis=0)
            yield pdf.assign(outlier_score=(2.0 ** (-depth / scale))[back.reshape(-1)])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", outlier_score double"
    return rows.mapInPandas(score, schema)


def score_threshold(scored: DataFrame, contamination: float, error: float = ERROR) -> float:
    """Score from which the given share of rows counts as anomalous. It is a score of some row whose rank is off by at
    most `error` times the rows, from quantile summaries that tasks make and merge; their size depends on `error`."""
    share = F.percentile_approx("outlier_score", 1.0 - contamination, int(round(1.0 / error)))
    found = scored.agg(share.alias("t")).first()["t"]
    return 1.0 if found is None else float(found)


def isolation_forest(
    rows: DataFrame,
    key: str,
    columns: list[str],
    trees: int = 100,
    sample: int = 256,
    contamination: float = 0.02,
    seed: int = 42,
) -> DataFrame:
    """(key, outlier_score, anomaly_flag) of every row."""
    forest = fit_forest(rows, key, columns, trees, sample, seed)
    scored = written(score_forest(rows.select(key, *columns), forest, columns), "scores")
    threshold = score_threshold(scored, contamination)
    flag = (F.col("outlier_score") >= threshold).cast("double")
    return scored.select(key, "outlier_score", flag.alias("anomaly_flag"))


def top_anomalies(scored: DataFrame, key: str, k: int = 25) -> DataFrame:
    """The `k` rows with the highest outlier score, ties by id."""
    return scored.orderBy(F.desc("outlier_score"), key).limit(k)


def checks(rows: DataFrame, scored: DataFrame, key: str, columns: list[str], contamination: float = 0.02, error: float = ERROR) -> DataFrame:
    """(check, holds): what must hold of `scored`, the result of `isolation_forest` over `rows`, whatever the trees.

    Rows with the lowest flagged score may tie, so the flagged share is bounded from above without them.
    """
    flagged, score = F.col("anomaly_flag") == 1, F.col("outlier_score")
    # One row.
    total = scored.agg(
        F.count("*").alias("n"), F.count_distinct(key).alias("ids"), F.count_if(flagged).alias("flagged"),
        F.min(F.when(flagged, score)).alias("low"), F.max(F.when(~flagged, score)).alias("high"),
        F.bool_and((score > 0) & (score <= 1)).alias("inside"),
    )
    above = scored.where(score > total.select("low").scalar()).agg(F.count("*").alias("above"))
    alike = rows.join(scored, key).groupBy(*columns).agg((F.min("outlier_score") == F.max("outlier_score")).alias("same"))
    alike = alike.agg(F.bool_and("same").alias("same"))
    given = rows.agg(F.count("*").alias("given"))
    one = total.withColumns({"above": above.scalar(), "same": alike.scalar(), "given": given.scalar()})
    slack = F.col("n") * error + 1
    held = {
        "each row scored once": (F.col("n") == F.col("given")) & (F.col("ids") == F.col("given")),
        "scores in range": F.col("inside"),
        "equal rows, equal scores": F.col("same"),
        "flags follow scores": F.col("high").isNull() | (F.col("high") < F.col("low")),
        "share flagged, at least": F.col("flagged") >= F.col("n") * contamination - slack,
        "share flagged, at most": F.col("above") <= F.col("n") * contamination + slack,
    }
    listed = F.array(*[F.struct(F.lit(name).alias("check"), F.coalesce(c, F.lit(False)).alias("holds")) for name, c in held.items()])
    return one.select(F.inline(listed))
