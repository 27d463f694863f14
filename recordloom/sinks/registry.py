"""The exchanged registry file: 13 tab-separated columns, `null` for an absent value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.schema import CONTRACT, ENTITY_COLUMNS, NULL_TOKEN, REQUIRED


def registry_row() -> Column:
    """One entity rendered as a line."""

    def cell(name: str) -> Column:
        if name in REQUIRED:
            return F.coalesce(F.col(name), F.lit(""))
        value = F.array_join(name, ",") if name == "umls_cuis" else F.col(name)
        return F.coalesce(F.nullif(value, F.lit("")), F.lit(NULL_TOKEN))

    return F.concat_ws("\t", *[cell(c) for c in ENTITY_COLUMNS])


def write_registry_tsv(df: DataFrame, path: str) -> None:
    """Header and rows in id order. The part files, joined in name order, are the exchanged file
    byte for byte (`hadoop fs -getmerge`), so no single task has to write the whole table."""
    header = df.sparkSession.range(1, numPartitions=1).select(
        F.lit(0).alias("rank"),
        F.lit("").alias("id"),
        F.lit("\t".join(CONTRACT.values())).alias("value"),
    )
    rows = df.select(F.lit(1).alias("rank"), F.col("drugbank_id").alias("id"), registry_row().alias("value"))
    header.unionByName(rows).orderBy("rank", "id").select("value").write.mode("overwrite").text(path)


def write_registry_sharded(df: DataFrame, path: str) -> None:
    """Lines without header or order, written as the table is partitioned."""
    df.select(registry_row().alias("value")).write.mode("overwrite").text(path)
