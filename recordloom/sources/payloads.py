"""Answers of the identifier services, stored as a table (id, kind, status, body), turned into values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Answer kind -> JSON layout.
LAYOUTS = {
    "unichem": "array<struct<src_compound_id: string>>",
    "pubchem": "struct<IdentifierList: struct<CID: array<bigint>>>",
    "umls": "struct<result: struct<results: array<struct<ui: string, name: string, rootSource: string>>>>",
    "dgidb": "struct<matchedTerms: array<struct<drugName: string, conceptId: string>>>",
}


def _found(kind: str, doc: Column) -> Column:
    if kind == "unichem":
        return F.get(doc, F.lit(0))["src_compound_id"]
    if kind == "pubchem":
        return F.get(doc["IdentifierList"]["CID"], F.lit(0)).cast("string")
    if kind == "dgidb":
        return F.get(doc["matchedTerms"], F.lit(0))["conceptId"]
    codes = F.array_distinct(F.transform(doc["result"]["results"], lambda r: r["ui"]))
    return F.nullif(F.array_join(F.filter(codes, lambda u: u != "NONE"), ","), F.lit(""))


def decode_payloads(payloads: DataFrame) -> DataFrame:
    """(id, kind, value): first hit of the service, or all distinct concept codes joined by commas.
    A not-found answer, an error status and an unreadable body all give NULL."""
    value = F.lit(None).cast("string")
    for kind, layout in LAYOUTS.items():
        value = F.when(F.col("kind") == kind, _found(kind, F.from_json("body", layout))).otherwise(value)
    return payloads.select("id", "kind", F.when(F.col("status") < 400, value).alias("value"))
