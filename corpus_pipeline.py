"""A training-data pipeline: quality, near duplicates, benchmark decontamination, personal data, packing.

Each stage takes what its predecessor kept and its decisions take effect: documents of low quality go, one document
of each class of near duplicates stays, documents in which a benchmark window occurs go, personal data is replaced
by surrogates, and what is left is packed. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import decontaminate, jaccard, packing, quality, surrogates
from recordloom.llm.queries import SURROGATE_KEY, TOKENIZER, table
from recordloom.scratch import written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    weights, _ = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep(docs, weights)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    replaced = surrogates.replace(docs, SURROGATE_KEY)
    # The surrogate of an address may be longer or shorter.
    return replaced.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else replaced


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(docs, TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", replace_personal_data),
    ("packing", pack),
]

#: A trained classifier has no equivalent in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
