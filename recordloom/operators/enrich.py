"""Fill missing identifiers from other sources. Existing values always win."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.text import strip_salts

# Entity column -> source column each named source may fill.
TTD_FILLS = {"ttd_id": "ttd_id", "cas_num": "cas_num", "pubchem_cid": "pubchem_cid"}
KEGG_FILLS = {"kegg_id": "kegg_id", "chebi_id": "chebi_id", "cas_num": "cas_num", "pubchem_cid": "pubchem_cid"}
STITCH_FILLS = {"stitch_id": "stitch_id"}

PROVENANCE = "array<struct<field:string,source:string,method:string,confidence:double,evidence:string>>"


@dataclass(frozen=True)
class Audit:
    """How a source's values are recorded in the `provenance` column."""

    source: str
    method: str
    confidence: float = 1.0


def is_missing(df: DataFrame, column: str) -> Column:
    """True where an id is absent, or a list of codes empty."""
    if df.schema[column].dataType.typeName() == "array":
        return F.size(column) == 0
    return F.col(column).isNull()


def with_audit_columns(df: DataFrame) -> DataFrame:
    """Add an empty audit trail, an unset anomaly score and no reasons."""
    return df.select(
        "*",
        F.array().cast(PROVENANCE).alias("provenance"),
        F.lit(None).cast("double").alias("anomaly_score"),
        F.array().cast("array<string>").alias("reasons"),
    )


def with_provenance(df: DataFrame, field: str, audit: Audit, when: Column, evidence: Column | None = None) -> DataFrame:
    """Append an audit entry to the rows where `when` holds."""
    entry = F.struct(
        F.lit(field).alias("field"),
        F.lit(audit.source).alias("source"),
        F.lit(audit.method).alias("method"),
        F.lit(audit.confidence).alias("confidence"),
        (F.lit("") if evidence is None else evidence).alias("evidence"),
    )
    return df.withColumn(
        "provenance", F.when(when, F.array_append("provenance", entry)).otherwise(F.col("provenance"))
    )


def with_reason(df: DataFrame, reason: Column) -> DataFrame:
    """Append a reason; rows where it is NULL keep their list."""
    return df.withColumn(
        "reasons", F.when(reason.isNotNull(), F.array_append("reasons", reason)).otherwise(F.col("reasons"))
    )


def fill_missing(df: DataFrame, values: dict[str, Column], audit: Audit | None = None) -> DataFrame:
    """Set each column from its value where it is missing. A string value for the code list is split
    on commas, blanks dropped, codes not trimmed. With `audit`, every fill leaves an audit entry."""
    filled: dict[str, Column] = {}
    for column, value in values.items():
        missing = is_missing(df, column)
        if audit:
            df = with_provenance(df, column, audit, missing & value.isNotNull(), value)
        if column == "umls_cuis":
            value = F.filter(F.split(value, ","), lambda x: x != "")
        filled[column] = F.when(missing & value.isNotNull(), value).otherwise(F.col(column))
    return df.withColumns(filled)


def merge_by_name(
    base: DataFrame, source: DataFrame, fills: dict[str, str], on_duplicate: str = "all", audit: Audit | None = None
) -> DataFrame:
    """Left join on the salt-free normalised name, then fill.

    A source with several rows of one name gives one output row per match. `on_duplicate="first"`
    reduces the source to its fullest row per name first (a map-side combined aggregate), so the
    output has exactly the rows of `base` however often a name repeats on either side.
    """
    renamed = {column: f"_src_{column}" for column in fills}
    keyed = source.select(
        strip_salts(F.col("name")).alias("_key"),
        *[F.nullif(F.col(origin), F.lit("")).alias(renamed[column]) for column, origin in fills.items()],
    )
    if on_duplicate == "first":
        keyed = keyed.groupBy("_key").agg(fullest(renamed.values()).alias("_row")).select("_key", "_row.*").drop("_absent")
    joined = base.withColumn("_key", strip_salts(F.col("name"))).join(keyed, "_key", "left")
    return fill_missing(joined, {c: F.col(r) for c, r in renamed.items()}, audit).drop("_key", *renamed.values())


def merge_by_id(
    base: DataFrame, source: DataFrame, fills: dict[str, str], key: str = "drugbank_id", audit: Audit | None = None
) -> DataFrame:
    """Left join on the entity id, then fill."""
    renamed = {column: f"_src_{column}" for column in fills}
    keyed = source.select(key, *[F.col(origin).alias(renamed[column]) for column, origin in fills.items()])
    joined = base.join(keyed, key, "left")
    return fill_missing(joined, {c: F.col(r) for c, r in renamed.items()}, audit).drop(*renamed.values()).select(
        *[F.col(c) for c in base.columns]
    )


def apply_lookup(base: DataFrame, lookup: DataFrame, column: str, audit: Audit | None = None) -> DataFrame:
    """Fill one column from an (id, value) lookup. Spark broadcasts the lookup when its measured size
    allows and shuffles it otherwise."""
    keyed = lookup.select(F.col("id").alias("drugbank_id"), F.col("value").alias("_src_value"))
    joined = base.join(keyed, "drugbank_id", "left")
    return fill_missing(joined, {column: F.col("_src_value")}, audit).select(*base.columns)


def missing_keys(
    base: DataFrame, column: str, lookup: DataFrame | None = None, by: tuple[str, ...] = ("drugbank_id", "name")
) -> DataFrame:
    """Distinct keys still lacking `column` and not answered by the saved lookup: the work list of
    the next round of look-ups."""
    keys = base.where(is_missing(base, column)).select(*by).distinct()
    if lookup is None:
        return keys
    return keys.join(lookup.select(F.col("id").alias("drugbank_id")), "drugbank_id", "left_anti").select(*by)


def corroborate(base: DataFrame, evidence: DataFrame) -> DataFrame:
    """Compare each record's ChEMBL id with independent evidence, found by id or else by name.

    Status: `agree` when the evidence lists the record's id, `conflict` when it lists only others,
    `missing` when it has one the record lacks, `unverified` without evidence. Fields do not change.
    """
    value = F.regexp_replace("chembl_id", "^chembl:", "")
    rows = evidence.where(F.col("chembl_id").isNotNull()).select(
        "drugbank_id", strip_salts(F.col("name")).alias("_name"), value.alias("_value")
    )

    def lookups(key: str, tag: str) -> tuple[DataFrame, DataFrame]:
        known = rows.where(F.col(key).isNotNull())
        first = known.groupBy(F.col(key).alias("_k")).agg(F.min("_value").alias(f"_first_{tag}"))
        exact = known.select(F.col(key).alias("_k"), F.col("_value").alias("_v")).distinct()
        return first, exact.withColumn(f"_hit_{tag}", F.lit(True))

    out = base.select("drugbank_id", "name", "chembl_id", strip_salts(F.col("name")).alias("_name"))
    for key, tag in (("drugbank_id", "id"), ("_name", "name")):
        first, exact = lookups(key, tag)
        out = out.join(first, out[key] == first["_k"], "left").drop("_k")
        out = out.join(exact, (out[key] == exact["_k"]) & (out["chembl_id"] == exact["_v"]), "left").drop("_k", "_v")
    by_id = F.col("_first_id").isNotNull()
    seen = F.coalesce("_first_id", "_first_name")
    hit = F.when(by_id, F.col("_hit_id")).otherwise(F.col("_hit_name"))
    status = (
        F.when(seen.isNull(), "unverified")
        .when(F.col("chembl_id").isNull(), "missing")
        .when(hit, "agree")
        .otherwise("conflict")
    )
    found = F.when(hit, F.col("chembl_id")).otherwise(seen)
    return out.select("drugbank_id", "chembl_id", found.alias("evidence_chembl_id"), status.alias("status"))


def with_conflicts(base: DataFrame, evidence: DataFrame) -> DataFrame:
    """Add a reason to each record whose ChEMBL id the evidence contradicts; ids and other rows stay as they are."""
    key = ["drugbank_id", "chembl_id"]
    conflicts = corroborate(base, evidence).where(F.col("status") == "conflict")
    seen = conflicts.groupBy(*key).agg(F.min("evidence_chembl_id").alias("_seen"))
    reason = F.concat(F.lit("chembl_id "), "chembl_id", F.lit(" contradicted by "), "_seen")
    return with_reason(base.join(seen, key, "left"), reason).select(*base.columns)


def fullest(columns: Iterable[str]) -> Column:
    """Aggregate: of rows the one with the most values present, the smallest of equally full ones."""
    columns = list(columns)
    absent = sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))
    return F.min(F.struct(absent.alias("_absent"), *columns))


def one_row_per_id(df: DataFrame, key: str = "drugbank_id") -> DataFrame:
    """One row per id, the fullest when merges have multiplied it."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(fullest(rest).alias("_row")).select(key, "_row.*").select(*df.columns)
