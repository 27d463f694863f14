"""Jaro-Winkler threshold join: all pairs of names of a block that are alike enough, without pairing off the block.

A Jaro score of at least j needs m matched letters with m/|a| + m/|b| >= 3j - 1. Hence, for |a| <= |b|,

* |a| >= (3j - 2) |b|  (the length filter);
* the names share at least (3j - 1) |a| |b| / (|a| + |b|) letters, repeated ones counted (the signature).

The letters of a name, each with its number among equal ones, are put in one order for all names, rarest first.
Two names that share o of them share one among the first |a| - o + 1 and |b| - o + 1 (the prefix filter), so these
are the join keys. A pair is kept at the first key its names have in common, if it passes the length filter and the
signature; only then is its similarity computed. Any order is exact; letters are ordered by how many names hold
them, as far as a table of fixed size tells.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions.similarity import with_jaro_winkler
from recordloom.partitioning import spread
from recordloom.scratch import written

#: Letters whose counts are told apart; all others count as rarest.
_COUNTED = 4096
_PLANE = 0x110000


def least_jaro(threshold: float) -> float:
    """The smallest Jaro score that can reach a Jaro-Winkler threshold: four common first letters raise a score of
    at least 0.7 by four tenths of what is missing."""
    return min(threshold, max(0.7, (threshold - 0.4) / 0.6))


def _numbered(name: str) -> list[int]:
    """Each letter with its number among equal ones."""
    seen: Counter[str] = Counter()
    out = []
    for c in name:
        out.append(seen[c] * _PLANE + ord(c))
        seen[c] += 1
    return out


def _letter_counts(names: DataFrame) -> dict[int, int]:
    """How many names hold each numbered letter, for the most frequent ones."""

    def letters(batches):
        for batch in batches:
            counts: Counter[int] = Counter()
            for name in batch.column(0).to_pylist():
                counts.update(_numbered(name))
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), type=pa.int64()), pa.array(counts.values(), type=pa.int64())], names=["letter", "n"])

    counted = names.select("name").mapInArrow(letters, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n"))
    return {r["letter"]: r["n"] for r in counted.orderBy(F.desc("n"), "letter").limit(_COUNTED).collect()}


def signatures(names: DataFrame) -> DataFrame:
    """Add `letters`: the numbered letters of `name`, rarest first."""
    sent = names.sparkSession.sparkContext.broadcast(_letter_counts(names))

    def ordered(column: pa.Array) -> pa.Array:
        counts = sent.value
        rows = [sorted(_numbered(x), key=lambda c: (counts.get(c, 0), c)) for x in column.to_pylist()]
        return pa.array(rows, type=pa.list_(pa.int64()))

    signature = F.arrow_udf(ordered, T.ArrayType(T.LongType())).asNondeterministic()
    return names.withColumn("letters", signature(F.col("name")))


def similar_names(names: DataFrame, threshold: float = 0.92, chunk: int = 2000) -> DataFrame:
    """(name_a, name_b) of distinct non-empty names (block, name), name_a < name_b, of one block whose Jaro-Winkler
    similarity is at least `threshold`.

    A key held by more than `chunk` names is cut into chunks: each name keeps one chunk on the left and visits every
    chunk on the right, so a block or a letter that most names share is spread over many tasks.
    """
    share = 3.0 * least_jaro(threshold) - 1.0
    if share <= 1.0:
        raise ValueError("names so unlike may have no letter in common")
    # Rounding of the scores must not lose a pair.
    share -= 1e-9
    signed = written(signatures(names.select("block", "name").distinct()).withColumn("size", F.size("letters")), "signatures")

    def first(shared: str) -> Column:
        """Letters enough that one of any `shared` must be among them."""
        return F.slice("letters", F.lit(1), (F.col("size") - F.ceil(F.expr(shared)) + 1).cast("int"))

    # The shorter name of a pair shares most with a partner of its own length, the longer one least with the shortest.
    short = signed.withColumn("prefix", first(f"{share / 2} * size"))
    long = signed.withColumn("prefix", first(f"{share - 1.0} * size"))
    keyed = F.posexplode("prefix").alias("at", "letter")
    right = long.select("block", "name", "size", "letters", keyed)
    held = right.groupBy("block", "letter").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    chunks = held.select("block", "letter", F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    on = ["block", "letter"]
    left = short.select("block", "name", "size", "letters", keyed).join(chunks, on)
    left = left.select(*on, F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), *[F.col(c).alias(f"{c}_a") for c in ("name", "size", "letters", "at")])
    right = right.join(chunks, on)
    right = right.select(*on, F.pmod(F.hash("name"), F.col("chunks")).alias("chunk"), *[F.col(c).alias(f"{c}_b") for c in ("name", "size", "letters", "at")])
    ordered = (F.col("size_a") < F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("name_a") < F.col("name_b")))
    near = F.col("size_a") >= (share - 1.0) * F.col("size_b")
    met = left.join(right, [*on, "chunk"]).where(ordered & near)
    common = F.array_intersect("letters_a", "letters_b")
    needed = share * F.col("size_a") * F.col("size_b") / (F.col("size_a") + F.col("size_b"))
    # The first common letter is the first key in common, so a pair is tested at one key.
    tested = met.withColumn("common", common).where((F.get("common", F.lit(0)) == F.col("letter")) & (F.size("common") >= needed))
    pairs = spread(tested.select(F.least("name_a", "name_b").alias("name_a"), F.greatest("name_a", "name_b").alias("name_b")))
    return with_jaro_winkler(pairs, "name_a", "name_b").where(F.col("name_jaro_winkler") >= threshold).select("name_a", "name_b")
