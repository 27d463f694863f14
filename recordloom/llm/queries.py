"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import collocations, decontaminate, jaccard, language, licences, linear, neighbours, packing, periods, quality, suffixes, surrogates, toxicity, warc
from recordloom.scratch import new_path, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: A session would take this from a secret store.
SURROGATE_KEY = "recordloom-surrogates"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _scored(scores: DataFrame, threshold: float) -> DataFrame:
    predicted = (F.col("score") >= threshold).cast("int")
    return scores.select("doc_id", linear.held_out("doc_id").alias("held_out"), "score", predicted.alias("predicted"))


@query
def op1_toxicity_mil(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    weights = toxicity.train(documents, table(spark, sf_dir, "labels"))
    return _scored(toxicity.score(documents, weights), 0.5)


@query
def op2_pii_surrogates(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace(documents, SURROGATE_KEY)


@query
def op3_quality_pu(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    weights, _ = quality.train(documents, table(spark, sf_dir, "labels"))
    return _scored(quality.score(documents, weights), 0.3)


@query
def op4_suffix_dedup(spark, sf_dir):
    return suffixes.digests(suffixes.removed(table(spark, sf_dir, "documents")))


@query
def op5_warc_transactions(spark, sf_dir):
    path = new_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    # Headers are small; the joins read them several times.
    found = warc.captures(written(warc.read_archives(spark, path, payloads=False), "warc-records"))
    complete = F.col("request").isNotNull() & (F.size("metadata") == 1)
    return found.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_to_page").alias("refers_to"), complete.alias("complete")
    )


@query
def op6_group_jaccard(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_wu_manber(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.summary(found)


@query
def op8_nn_descent(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), every=100)


@query
def op9_language_spans(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    found = language.identify(documents, language.train(documents))
    return found.select("doc_id", linear.held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query
def op10_packing(spark, sf_dir):
    return packing.digests(packing.pack(table(spark, sf_dir, "documents"), TOKENIZER))


@query
def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op12_periodic_runs(spark, sf_dir):
    return periods.summary(periods.collapse(table(spark, sf_dir, "documents"), looped=True, texts=False))


@query
def op13_licence_scan(spark, sf_dir):
    return licences.summary(licences.scan(table(spark, sf_dir, "documents"))).drop("spans")
