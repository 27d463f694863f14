"""Readable reasons for link decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.operators.scoring import AGREES_FROM, LinkModel, fs_score

# Field -> wording; other fields keep their name.
WORDING = {
    "shared_inchikey": "InChIKey skeleton",
    "shared_cas": "CAS number",
    "shared_pubchem": "PubChem CID",
    "shared_chembl": "ChEMBL id",
    "name_jaro_winkler": "name (Jaro-Winkler)",
    "token_jaccard": "name tokens (Jaccard)",
}


def field_label(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in WORDING.items() for x in pair])
    return F.coalesce(F.try_element_at(table, name), name)


def reasons(contributions: Column) -> Column:
    """One line per field, strongest evidence first; equal strengths keep their order."""
    ranked = F.array_sort(
        F.transform(contributions, lambda w, i: F.struct((-F.abs(w["bits"])).alias("k"), i.alias("i"), w.alias("w")))
    )
    return F.transform(
        ranked,
        lambda r: F.format_string(
            "%s %s: %+.1f bits",
            field_label(r["w"]["field"]),
            F.when(r["w"]["agreed"], "agreement").otherwise("disagreement"),
            r["w"]["bits"],
        ),
    )


def _told(links: DataFrame) -> DataFrame:
    """Add `reasons` and `tail`, the summary behind the decision."""
    told = links.withColumn("reasons", reasons(F.col("contributions")))
    head = F.format_string(" (posterior %.3f, total %+.1f bits) — ", "posterior", "total_bits")
    return told.withColumn("tail", F.concat(head, F.array_join("reasons", "; ")))


def _known(spark: SparkSession, model: LinkModel) -> tuple[Column, Column]:
    """`reasons` and `tail` of links scored by `model`: worded once for every set of agreeing fields, then looked up."""
    agreed = {f: F.col("id").bitwiseAND(F.lit(1 << i)) != 0 for i, f in enumerate(model.used)}
    every = spark.range(0, 1 << len(model.used), 1, 1).withColumns({f: c.cast("double") if f in AGREES_FROM else c for f, c in agreed.items()})
    rows = _told(fs_score(every, model)).select("id", "reasons", "tail").collect()
    rows = sorted(rows, key=lambda r: r["id"])
    which = F.lit(1)
    for i in range(len(model.used)):
        which = which + F.when(F.get("contributions", F.lit(i))["agreed"], 1 << i).otherwise(0)
    worded = F.array(*[F.array(*[F.lit(x) for x in r["reasons"]]) for r in rows])
    return F.element_at(worded, which), F.element_at(F.array(*[F.lit(r["tail"]) for r in rows]), which)


def explain(links: DataFrame, model: LinkModel | None = None) -> DataFrame:
    """Add `reasons` and a one-line `summary` to links. Where all links were scored by one `model`, naming it saves
    wording each of them anew: what is said depends on the fields that agree, and on nothing else."""
    if model is None:
        told = _told(links)
    else:
        worded, tail = _known(links.sparkSession, model)
        told = links.withColumn("reasons", worded).withColumn("tail", tail)
    head = [F.coalesce(c, F.lit("null")) for c in (F.col("id_a"), F.col("id_b"), F.upper("decision"))]
    return told.withColumn("summary", F.concat(head[0], F.lit(" ~ "), head[1], F.lit(": "), head[2], "tail")).drop("tail")
